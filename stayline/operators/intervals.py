"""Interval relations expanded to hourly indicators (D04: X02, X03, U07, J10, J21, W06, P19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.timefns import add_hours, floor_hours
from stayline.operators.hourly import fill_hours, spread_by_stay
from stayline.operators.ordered import lag_within


def next_start_end(df: DataFrame, keys: list[str], start: str, stay_end: str | None = None,
                   fallback_hours: float = 0.0, tiebreak: list[str] | None = None,
                   name: str = "endtime") -> DataFrame:
    """Interval end = next start of the same key (LEAD), else ``stay_end + fallback``."""
    d = lag_within(df, keys, start, [start], tiebreak=tiebreak, prefix="__next_", descending=True)
    fb = add_hours(stay_end, fallback_hours) if stay_end is not None else F.col(start)
    return d.withColumn(name, F.coalesce(F.col("__next_" + start), fb)).drop("__next_" + start)


def bolus_intervals(df: DataFrame, time_col: str = "charttime") -> DataFrame:
    """A point event as a zero-length interval."""
    return df.withColumn("starttime", F.col(time_col)).withColumn("endtime", F.col(time_col))


def interval_spans(intervals: DataFrame, stays: DataFrame, stay: str, name: str | None,
                   start: str = "starttime", end: str = "endtime", name_col: str | None = None) -> DataFrame:
    """(stay, __from, __to, __iv): the first and last hour an interval touches.

    Only intervals that start and end inside the stay are used (P07), hours
    run floor((start-intime)/1h) .. floor((end-intime)/1h) inclusive."""
    s = stays.select(stay, F.col("intime").alias("__in"), F.col("outtime").alias("__out"))
    label = F.col(name_col) if name_col else F.lit(name)
    d = intervals.select(stay, start, end, label.alias("__iv")).join(s, stay, "inner")
    d = d.filter(F.col(start).between(F.col("__in"), F.col("__out"))
                 & F.col(end).between(F.col("__in"), F.col("__out")))
    sh, eh = floor_hours("__in", start), floor_hours("__in", end)
    return d.filter(eh >= sh).select(stay, sh.alias("__from"), eh.alias("__to"), "__iv")


def interval_hours(intervals: DataFrame, stays: DataFrame, stay: str, name: str | None,
                   start: str = "starttime", end: str = "endtime", name_col: str | None = None) -> DataFrame:
    """(stay, hours_in, name) for every hour an interval touches."""
    d = interval_spans(intervals, stays, stay, name, start, end, name_col)
    return d.select(stay, F.explode(F.sequence("__from", "__to")).alias("hours_in"), "__iv")


def hourly_indicators_from(stays: DataFrame, stay: str, spans: DataFrame, names: list[str]) -> DataFrame:
    """Like ``hourly_indicators`` on the whole grid of ``stays`` (with max_hours)
    for one table of ``interval_spans`` whose ``__iv`` names the intervention (one
    join to the stays for all of them).  Spans of the same hours count once, so
    a stay with many events an hour is no heavier than its hours; spans
    become hours only where their stay's task holds them."""
    d = spread_by_stay(spans.select(stay, "__from", "__to", "__iv").distinct(), stays, [stay])
    hours = F.when(F.col("__last").isNull(), F.sequence("__from", "__to"))
    d = d.select(stay, "__iv", "__last", F.explode_outer(hours).alias("hours_in"))
    aggs = [F.max(F.when(F.col("__iv") == nm, 1).otherwise(0)).cast("int").alias(nm) for nm in names]
    d = fill_hours(d.groupBy(stay, "hours_in", "__last").agg(*aggs), [stay])
    return d.select(stay, "hours_in", *[F.coalesce(F.col(nm), F.lit(0)).alias(nm) for nm in names])


def hourly_indicators(grid: DataFrame, stay: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Dense 0/1 indicator columns on the grid, one per intervention.

    All expanded hours are unioned with the grid rows and reduced by one
    aggregation on (stay, hour): an hour covered twice counts once (U07), a
    stay without the intervention gets zeros (X03/J21), and there is no
    per-intervention merge (J10)."""
    g = grid.select(stay, "hours_in", F.lit(None).cast("string").alias("__iv"))
    u = g
    for nm, p in parts.items():
        u = u.unionByName(p.select(stay, "hours_in", F.lit(nm).alias("__iv")))
    # No semi join back to the grid is needed: interval_hours only keeps
    # intervals inside the stay, whose hours are therefore 0..max_hours.
    aggs = [F.max(F.when(F.col("__iv") == nm, 1).otherwise(0)).cast("int").alias(nm) for nm in parts]
    return u.groupBy(stay, "hours_in").agg(*aggs)
