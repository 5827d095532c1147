"""Bindings of the operators to the provided tables (see SURVEY §7.4).

Each registered query takes ``(spark, sf_dir)`` and returns a DataFrame over
the whole tables; ``ORACLE`` holds the equivalent DuckDB SQL where one exists.
"""

from stayline.plans.registry import ORACLE, QUERIES  # noqa: F401
from stayline.plans import (events_plans, orders_plans, docs_plans, model_plans, features_plans,  # noqa: F401
                            more_plans)
