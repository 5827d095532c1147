"""Backward as-of join with a tolerance (J06, W15) and the hour-grid lookup.

Spark SQL has no as-of join.  Joining every left row to every right row of
its key and keeping the latest would emit all pairs of a stay; instead both
sides are unioned and one window per (key, time bucket) carries the latest right row forward.
Each right row is copied into its own bucket and the following ones up to
the reach of ``[t - tolerance, t]``, so no pairs are produced and a hot key
is spread over its time buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.timefns import US_PER_SECOND, diff_us, time_bucket


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str,
                  tolerance_seconds: int, right_cols: list[str], prefix: str,
                  tiebreak: list[str] | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """For each left row, the right row of the same ``by`` key with the largest
    ``right_ts`` in ``[left_ts - tolerance, left_ts]`` (inclusive both ends);
    ties on time go to the largest ``tiebreak`` values.  Left rows without a
    candidate keep NULLs (left join).  Output: left columns + ``prefix+c``.

    ``bucket_seconds`` (default: the tolerance) sets the window partition
    width; a smaller width splits a very dense key further, at the price of
    copying each right row into ``ceil(tolerance / width) + 1`` buckets."""
    tiebreak = tiebreak or []
    width = int(bucket_seconds or tolerance_seconds)
    copies = -(-int(tolerance_seconds) // width)
    tol_us = int(tolerance_seconds) * US_PER_SECOND
    lcols = left.columns
    lpay = F.struct(*[F.col(c) for c in lcols])
    rpay = F.struct(F.col(right_ts).alias("__rts"), *[F.col(c).alias(c) for c in right_cols])
    tb = F.lit(None).cast("double")

    L = left.select(*[F.col(k) for k in by], F.col(left_ts).alias("__t"), F.lit(1).alias("__kind"),
                    time_bucket(left_ts, width).alias("__b"),
                    lpay.alias("__l"), F.lit(None).cast(right.select(rpay).schema[0].dataType).alias("__r"),
                    *[tb.alias(f"__tb{i}") for i in range(len(tiebreak))])
    rb = time_bucket(right_ts, width)
    for k in by:  # a NULL key matches nothing
        right = right.filter(F.col(k).isNotNull())
    R = right.select(*[F.col(k) for k in by], F.col(right_ts).alias("__t"), F.lit(0).alias("__kind"),
                     F.explode(F.sequence(rb, rb + copies)).alias("__b"),
                     F.lit(None).cast(left.select(lpay).schema[0].dataType).alias("__l"), rpay.alias("__r"),
                     *[F.col(c).cast("double").alias(f"__tb{i}") for i, c in enumerate(tiebreak)])
    u = L.unionByName(R).filter(F.col("__t").isNotNull())
    order = [F.col("__t"), F.col("__kind")] + [F.col(f"__tb{i}").asc_nulls_first() for i in range(len(tiebreak))]
    w = Window.partitionBy(*by, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).filter(F.col("__kind") == 1)
    ok = F.col("__m").isNotNull() & (diff_us(F.col("__m.__rts"), F.col("__t")) <= tol_us)
    out = u.select(*[F.col("__l").getField(c).alias(c) for c in lcols],
                   F.when(ok, F.col("__m.__rts")).alias(prefix + right_ts),
                   *[F.when(ok, F.col("__m").getField(c)).alias(prefix + c) for c in right_cols])
    # Left rows with a NULL time never match but are kept, as in a left join.
    nulls = left.filter(F.col(left_ts).isNull()).select(
        *lcols, F.lit(None).cast(right.schema[right_ts].dataType).alias(prefix + right_ts),
        *[F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in right_cols])
    return out.unionByName(nulls)


def value_at_hour(hourly: DataFrame, stay: str, at: DataFrame, at_col: str, cols: list[str]) -> DataFrame:
    """Row of each stay at the latest hour ≤ ``at_col`` (else its first hour).

    ``hourly`` is a stay-by-hour table, ``at`` gives one target hour per stay."""
    h = hourly.join(at.select(stay, at_col), stay, "inner")
    row = F.struct(F.col("hours_in"), *[F.col(c) for c in cols])
    g = h.groupBy(stay).agg(
        F.max_by(row, F.when(F.col("hours_in") <= F.col(at_col), F.col("hours_in"))).alias("__prev"),
        F.min_by(row, F.col("hours_in")).alias("__first"))
    pick = F.coalesce(F.col("__prev"), F.col("__first"))
    return g.select(stay, pick.getField("hours_in").alias("hours_in"), *[pick.getField(c).alias(c) for c in cols])
