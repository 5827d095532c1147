"""Unit standardisation.

A rule fires for a row when the variable name contains the rule's name AND
(the name or the unit column contains the unit token, OR the value passes the
range test).  Rules are applied in order, each seeing the previous result, and
folded into one nested CASE expression so the whole cascade stays inside
whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UnitRule:
    name: str
    unit: str | None
    range_check: Callable[[Column], Column] | None
    convert: Callable[[Column], Column]


# The conversion table (name, unit token, range test, converter).
UNIT_CONVERSIONS = (
    UnitRule("weight", "oz", None, lambda x: x / 16.0 * 0.45359237),
    UnitRule("weight", "lbs", None, lambda x: x * 0.45359237),
    UnitRule("fraction inspired oxygen", None, lambda x: x > 1, lambda x: x / 100.0),
    UnitRule("oxygen saturation", None, lambda x: x <= 1, lambda x: x * 100.0),
    UnitRule("temperature", "f", lambda x: x > 79, lambda x: (x - 32) * 5.0 / 9),
    UnitRule("height", "in", None, lambda x: x * 2.54),
)


def contains_ci(col: Column, needle: str) -> Column:
    """Case-insensitive substring test where NULL counts as no match."""
    return F.coalesce(F.lower(col).contains(needle.lower()), F.lit(False))


def standardize_units(value: Column, name: Column, unit: Column,
                      rules=UNIT_CONVERSIONS) -> Column:
    v = value
    for r in rules:
        needs = F.lit(False)
        if r.unit is not None:
            needs = needs | contains_ci(name, r.unit) | contains_ci(unit, r.unit)
        if r.range_check is not None:
            needs = needs | F.coalesce(r.range_check(v), F.lit(False))
        v = F.when(contains_ci(name, r.name) & needs, r.convert(v)).otherwise(v)
    return v


def apply_unit_rules(df, value: str, name: str, unit: str | None, rules=UNIT_CONVERSIONS):
    """The same cascade on a DataFrame, one projection per rule: each rule
    reads the previous rule's column instead of re-embedding the whole
    expression, so the plan stays linear in the number of rules (nesting the
    CASE expressions would grow it geometrically)."""
    u = F.col(unit) if unit else F.lit(None).cast("string")
    cols = [c for c in df.columns if c != value]
    for r in rules:
        df = df.select(*cols, standardize_units(F.col(value), F.col(name), u, (r,)).alias(value))
    return df
