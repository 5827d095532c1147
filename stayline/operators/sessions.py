"""Gap-based sessions (D09: W03 lag, W04 running session number, A06 HAVING, W05 renumber).

A flagged observation starts a new session when the previous flagged
observation of the same stay is more than ``gap`` earlier (strictly).  Sessions
with a single time point are dropped and the rest renumbered 1..n by start.

Scale: instead of one window over a whole stay (a hot stay would be one
task), observations are first cut into session *fragments* inside
(stay, time-bucket) partitions; only the fragments (at most one per bucket
plus one per session) are ordered per stay and stitched together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.timefns import US_PER_HOUR, diff_us, duration_hours, time_bucket


def gap_sessions(df: DataFrame, stay: str, ts: str, flag: str | None = None,
                 gap_hours: float = 8.0, bucket_seconds: int = 3600,
                 num_col: str = "session_no") -> DataFrame:
    """Return (stay, num_col, starttime, endtime, duration_hours, n_points)."""
    gap_us = int(gap_hours * US_PER_HOUR)
    x = df if flag is None else df.filter(F.col(flag) == 1)
    x = x.select(stay, ts).withColumn("__b", time_bucket(ts, bucket_seconds))
    w = Window.partitionBy(stay, "__b").orderBy(ts)
    prev = F.lag(ts).over(w)
    x = x.withColumn("__start", F.when(prev.isNull() | (diff_us(prev, F.col(ts)) > gap_us), 1).otherwise(0))
    x = x.withColumn("__frag", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    frags = x.groupBy(stay, "__b", "__frag").agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"),
                                                 F.count(F.lit(1)).alias("__n"))
    w2 = Window.partitionBy(stay).orderBy("__first", "__b")
    prev_last = F.lag("__last").over(w2)
    frags = frags.withColumn("__new", F.when(prev_last.isNull() | (diff_us(prev_last, F.col("__first")) > gap_us), 1)
                             .otherwise(0))
    frags = frags.withColumn("__sess", F.sum("__new").over(w2.rowsBetween(Window.unboundedPreceding, 0)))
    s = frags.groupBy(stay, "__sess").agg(F.min("__first").alias("starttime"), F.max("__last").alias("endtime"),
                                           F.sum("__n").alias("n_points"))
    s = s.filter(F.col("starttime") != F.col("endtime"))
    s = s.withColumn(num_col, F.row_number().over(Window.partitionBy(stay).orderBy("starttime")).cast("int"))
    return s.select(stay, num_col, "starttime", "endtime",
                    duration_hours("starttime", "endtime").alias("duration_hours"), "n_points")


def flag_any(df: DataFrame, keys: list[str], conds: dict[str, object], name: str = "flag") -> DataFrame:
    """MAX(CASE WHEN cond THEN 1 ELSE 0 END) per key (A31): the per-time-point
    therapy flag that feeds ``gap_sessions``."""
    cond = None
    for c in conds.values():
        cond = c if cond is None else (cond | c)
    return df.groupBy(*keys).agg(F.max(F.when(cond, 1).otherwise(0)).cast("int").alias(name))
