"""Text-to-number coercion and NaN normalisation (F01, F14, §8.1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted numeric text shapes (sign, digits, optional
# fraction, optional exponent) and the infinity spellings a pandas coercion keeps.
NUMERIC_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITY_PATTERN = r"^[+-]?(inf|infinity)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """Spark orders NaN above every number and lets it poison aggregates;
    the reference treats NaN as missing, so map it to NULL at ingest."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def to_number(x) -> Column:
    """Coerce text to double: well-formed numbers and infinities are kept,
    everything else (``'5 mg'``, ``'5d'``, ``'nan'``, ``''``) becomes NULL."""
    s = F.trim(_c(x).cast("string"))
    ok = s.rlike(NUMERIC_PATTERN) | F.lower(s).rlike(INFINITY_PATTERN)
    return nan_to_null(F.when(ok, s.try_cast("double")))


def round_numeric(x, n: int) -> Column:
    """ROUND(CAST(x AS numeric), n): half-up rounding on the decimal value."""
    return F.round(_c(x).cast("decimal(38,10)"), n).cast("double")
