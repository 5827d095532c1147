"""Deterministic data splits.

Draws come from a hash of (key, seed), so a split never depends on partition
layout or retries.  Fractions are exact: subjects are ranked by their hash
with a distributed global row number, and the first round(f·N) go to the
first part — all rows of a subject follow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.hashing import uniform
from stayline.operators.ordered import global_cumsum, global_row_number


def _ranked(keys_df: DataFrame, key: str, seed: int, strata: str | None = None) -> DataFrame:
    """Rank of every key by (hash, key), within its stratum when given, plus
    the stratum size ``__n``.  Strata are class labels (a handful of values):
    one running count per level over the same hash order, so no stratum is
    ranked in a single task."""
    d = keys_df.withColumn("__h", uniform(seed, key))
    if not strata:
        d = global_row_number(d, ["__h", key], "__r")
        return d.crossJoin(F.broadcast(d.agg(F.count(F.lit(1)).alias("__n"))))  # one-row table
    levels = [r[0] for r in keys_df.select(strata).distinct().collect()]
    ind = {f"__c{i}": F.when(F.col(strata).eqNullSafe(F.lit(v)), 1).otherwise(0).cast("long")
           for i, v in enumerate(levels)}
    d = d.withColumns(ind)
    d = global_cumsum(d, ["__h", key], {f"__r{i}": f"__c{i}" for i in range(len(levels))})
    rank = None
    for i, v in enumerate(levels):
        cond = F.col(strata).eqNullSafe(F.lit(v))
        rank = F.when(cond, F.col(f"__r{i}")) if rank is None else rank.when(cond, F.col(f"__r{i}"))
    d = d.withColumn("__r", rank).drop(*ind, *[f"__r{i}" for i in range(len(levels))])
    sizes = d.groupBy(strata).agg(F.count(F.lit(1)).alias("__n"))
    return d.join(F.broadcast(sizes), d[strata].eqNullSafe(sizes[strata])).drop(sizes[strata])


def subject_split(df: DataFrame, key: str, fractions=(("train", 0.7), ("dev", 0.1), ("test", 0.2)),
                  seed: int = 0, name: str = "split", strata: str | None = None) -> DataFrame:
    """Label each row with the split of its key; with ``strata``
    the fractions hold exactly within each stratum (stratified split)."""
    cols = [key] + ([strata] if strata else [])
    ks = df.select(*cols).distinct()
    r = _ranked(ks, key, seed, strata)
    cum, expr = 0.0, None
    for i, (lab, frac) in enumerate(fractions):
        cum += frac
        bound = F.bround(F.col("__n") * F.lit(cum), 0) if i < len(fractions) - 1 else F.col("__n")
        cond = F.col("__r") <= bound
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    r = r.select(*cols, expr.alias(name))
    return df.join(r, cols, "inner")


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 0, name: str = "fold") -> DataFrame:
    """Subject-grouped folds: subjects in the order of their hash are dealt
    round to the folds, so that fold sizes differ by one subject at most; every
    row of a subject gets the same fold."""
    r = _ranked(df.select(key).distinct(), key, seed)
    r = r.select(F.col(key).alias("__key"), F.pmod(F.col("__r") - 1, F.lit(k)).cast("int").alias(name))
    return df.join(r, df[key].eqNullSafe(r["__key"])).drop("__key")


def holdout_within(df: DataFrame, key: str, split_col: str, part: str, frac: float, seed: int = 1,
                   name: str = "early_stop") -> DataFrame:
    """A hashed share of one part's subjects held out (e.g. for early stopping)."""
    inside = (F.col(split_col) == part) & (uniform(seed, key) >= 1 - frac)
    return df.withColumn(name, inside)
