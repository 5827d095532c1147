"""Per-stay feature tables.

First/last values use ``min_by``/``max_by`` aggregates instead of
``ROW_NUMBER() ... = 1``: they are partial aggregates (map-side combine, no
sort, no hot-key task) and a (time, value) ordering key makes ties
deterministic — the earliest time with the smallest value is "first", the
latest time with the largest value is "last".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present(label_col: str, label: str, value: str) -> Column:
    return (F.col(label_col) == F.lit(label)) & F.col(value).isNotNull()


def first_value(value: str, ts: str, cond: Column) -> Column:
    key = F.struct(F.col(ts), F.col(value))
    return F.min_by(F.col(value), F.when(cond, key))


def last_value(value: str, ts: str, cond: Column) -> Column:
    key = F.struct(F.col(ts), F.col(value))
    return F.max_by(F.col(value), F.when(cond, key))


def label_features(df: DataFrame, keys: list[str], label_col: str, labels: list[str],
                   value: str = "valuenum", ts: str = "charttime",
                   stats=("first", "last", "min", "max", "avg")) -> DataFrame:
    """One row per key with ``<label>_<stat>`` columns, in one aggregation
    (the conditional pivot A02 and the two-level MIN/MAX/AVG A04)."""
    aggs = []
    for lab in labels:
        cond = _present(label_col, lab, value)
        v = F.when(cond, F.col(value))
        fns = {"first": lambda: first_value(value, ts, cond), "last": lambda: last_value(value, ts, cond),
               "min": lambda: F.min(v), "max": lambda: F.max(v), "avg": lambda: F.avg(v),
               "sum": lambda: F.sum(v), "count": lambda: F.count(v)}
        for st in stats:
            aggs.append(fns[st]().alias(f"{lab}_{st}".lower()))
    return df.groupBy(*keys).agg(*aggs)


def first_last_nonnull(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """groupby().first()/.last() after sorting by ``order``: the first and last
    non-NULL value of each column (A07), plus min/max/sum (A08)."""
    aggs = []
    for c in cols:
        cond = F.col(c).isNotNull()
        aggs += [F.min_by(F.col(c), F.when(cond, F.col(order))).alias(f"{c}_first"),
                 F.max_by(F.col(c), F.when(cond, F.col(order))).alias(f"{c}_last"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
                 F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{c}_sum")]
    return df.groupBy(*keys).agg(*aggs)


def latest_row(df: DataFrame, keys: list[str], ts: str, cols: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """The one latest row per key (J09's ``rn = 1`` relation) as an aggregate."""
    tiebreak = tiebreak or []
    row = F.struct(*[F.col(c) for c in [ts] + cols])
    key = F.struct(*[F.col(c) for c in [ts] + tiebreak])
    g = df.groupBy(*keys).agg(F.max_by(row, key).alias("__r"))
    return g.select(*keys, *[F.col("__r").getField(c).alias(c) for c in [ts] + cols])


def full_outer_coalesce(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """FULL OUTER JOIN with coalesced keys."""
    return a.join(b, keys, "full")
