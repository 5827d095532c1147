"""Cohort construction (D01, D20, D21: P02, P09, P12, J03, W02, O01, S04)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.timefns import US_PER_HOUR, diff_us, epoch_us, floor_hours
from stayline.operators.ordered import dense_rank_within, scan_agg_within

DAY_US = 24 * US_PER_HOUR


@dataclass(frozen=True)
class CohortParams:
    """Template variables of the cohort query."""
    min_age: float = 15.0
    min_day: float = 0.0
    min_dur: int = 12
    max_dur: int = 240
    limit: int | None = None
    excluded_unit: str = "NICU"


def stay_ordinals(stays: DataFrame, subject: str, time_col: str, name: str = "hospstay_seq") -> DataFrame:
    """DENSE_RANK() OVER (PARTITION BY subject ORDER BY time) (W02), time-bucketed
    so a subject with very many stays is not ranked in a single task."""
    return dense_rank_within(stays, [subject], time_col, name)


def readmission_30(stays: DataFrame, subject: str = "subject_id", stay: str = "icustay_id",
                   intime: str = "intime", outtime: str = "outtime", days: int = 30,
                   name: str = "readmission_30") -> DataFrame:
    """1 when a later stay c of the subject exists with ``c.id > d.id``,
    ``c.intime - d.outtime <= days`` and ``c.outtime`` equal to the earliest
    outtime among the subject's stays starting after ``d.outtime`` (J03).

    Two bucketed scans, no self join (a self join emits all stay pairs of a
    subject):
      1. m(d) = min outtime over stays with intime > d.outtime — a suffix-min
         scan over the union of start points and query points;
      2. among stays with outtime = m(d), the largest id with
         intime <= d.outtime + days — a prefix-max scan keyed by (subject, m).
    """
    s = stays.select(F.col(subject).alias("__s"), F.col(stay).alias("__id"),
                     F.col(intime).alias("__in"), F.col(outtime).alias("__out"))
    out_us = epoch_us("__out")
    # 1. start points (kind 0 sorts before a query at the same instant: strict '>')
    a = s.select("__s", F.col("__in").alias("__t"), F.lit(0).alias("__k"), out_us.alias("__v"),
                 F.lit(None).cast("long").alias("__q"), F.lit(None).cast("timestamp_ntz").alias("__qout"))
    b = s.select("__s", F.col("__out").cast("timestamp_ntz").alias("__t"), F.lit(1).alias("__k"),
                 F.lit(None).cast("long").alias("__v"), F.col("__id").alias("__q"),
                 F.col("__out").cast("timestamp_ntz").alias("__qout"))
    a = a.withColumn("__t", F.col("__t").cast("timestamp_ntz"))
    m = scan_agg_within(a.unionByName(b), ["__s"], "__t", "__v", "min", True, ["__k"], "__m")
    m = m.filter(F.col("__k") == 1).select("__s", "__q", "__qout", "__m")
    # 2. candidates keyed by (subject, outtime): largest id with intime <= d.outtime + days
    c = s.select("__s", out_us.alias("__m"), F.col("__in").cast("timestamp_ntz").alias("__t"),
                 F.lit(0).alias("__k"), F.col("__id").alias("__v"), F.lit(None).cast("long").alias("__q"))
    dq = m.filter(F.col("__m").isNotNull()).select(
        "__s", "__m", (F.col("__qout") + F.make_dt_interval(days=F.lit(days))).alias("__t"),
        F.lit(1).alias("__k"), F.lit(None).cast("long").alias("__v"), "__q")
    r = scan_agg_within(c.unionByName(dq), ["__s", "__m"], "__t", "__v", "max", False, ["__k"], "__best")
    r = r.filter(F.col("__k") == 1).select(F.col("__q").alias(stay),
                                           F.when(F.col("__best") > F.col("__q"), 1).otherwise(0).alias("__r"))
    r = r.groupBy(stay).agg(F.max("__r").alias(name))
    return stays.join(r, stay, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("int"))


def mortality_flags(df: DataFrame, death: str = "deathtime") -> DataFrame:
    """CASE WHEN deathtime BETWEEN ... THEN 1 ELSE 0."""
    icu = F.col(death).between(F.col("intime"), F.col("outtime"))
    hosp = F.col(death).between(F.col("admittime"), F.col("dischtime"))
    return (df.withColumn("mort_icu", F.when(icu, 1).otherwise(0).cast("int"))
              .withColumn("mort_hosp", F.when(hosp, 1).otherwise(0).cast("int")))


def cohort_filter(df: DataFrame, p: CohortParams, unit: str = "first_careunit") -> DataFrame:
    """Adult first stays of bounded duration, excluding a care unit.

    ``NOT LIKE`` drops NULL units, as in SQL; duration bounds use exact
    interval arithmetic."""
    d = df.filter(~F.col(unit).like(p.excluded_unit))
    d = d.filter(F.col("hadm_id").isNotNull() & F.col("icustay_id").isNotNull())
    d = d.filter((F.col("hospstay_seq") == 1) & (F.col("icustay_seq") == 1))
    d = d.filter((F.col("age") >= p.min_age) & (F.col("los_icu") >= p.min_day))
    dur = diff_us("intime", "outtime")
    return d.filter((dur >= p.min_dur * US_PER_HOUR) & (dur <= p.max_dur * US_PER_HOUR))


def first_rows(df: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """ORDER BY ... LIMIT n (O01) — a top-k (TakeOrderedAndProject) when limited."""
    d = df.orderBy(*order)
    return d.limit(limit) if limit else d


def restrict_to(df: DataFrame, cohort: DataFrame, keys: list[str]) -> DataFrame:
    """Keep rows of ``df`` whose keys are in the cohort (S04) as a semi join."""
    return df.join(cohort.select(*keys).distinct(), keys, "left_semi")


def latest_per(df: DataFrame, key: str, time_col: str) -> DataFrame:
    """Rows whose time equals the key's maximum (P12, ties kept) — an aggregate
    plus an equi join instead of a correlated subquery or a per-key sort."""
    mx = df.groupBy(key).agg(F.max(time_col).alias("__mx"))
    return (df.join(mx, key).filter(F.col(time_col) == F.col("__mx")).drop("__mx"))


def with_max_hours(df: DataFrame) -> DataFrame:
    return df.withColumn("max_hours", floor_hours("intime", "outtime"))
