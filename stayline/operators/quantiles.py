"""Exact interpolated percentiles without holding a whole group in one task.

Spark's exact ``percentile`` merges every value of a group into one buffer,
which fails for a group holding a large share of the data.  Here each target
rank is located by narrowing value intervals, the same way at every size:

1. per group, ``n`` gives the target ranks floor(q(n-1)) and the next one;
2. each round cuts a target's interval [lo, hi] into ``CELLS`` cells of equal
   width, counts the rows per cell (map-side first), and narrows the interval
   to the least and greatest value of the cell that holds the rank;
3. a target is done when both are the same value.

Infinite values get the outermost cells.  Result: one row per (keys, q) with
the value interpolated linearly between the two ranks, like
``quantile_cont``; a NULL key is a group like any other, NULL values are left
out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import cut_lineage

CELLS = 1024


def _cell(v: Column, lo: Column, hi: Column) -> Column:
    """0 .. CELLS + 1: finite values by equal widths (halved, so that the
    width of the whole double range stays finite), infinite ones outside."""
    inf = F.lit(float("inf"))
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    return (F.when(v == -inf, 0).when(v == inf, CELLS + 1)
            .when((lo == -inf) | (hi == inf), F.when(v < 0, 1).otherwise(2))
            .otherwise(F.least(F.floor(share * CELLS), F.lit(CELLS - 1)) + 1)).cast("int")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, qs: list[float]) -> DataFrame:
    d = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    g = d.groupBy(*keys).agg(F.count("__v").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    t = g.select(*keys, "__n", "__lo", "__hi", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    pos = F.col("q") * (F.col("__n") - 1)
    k1 = F.floor(pos).cast("long")
    which = F.explode(F.array(F.struct(F.lit(1).alias("w"), k1.alias("k")),
                              F.struct(F.lit(2).alias("w"), F.least(k1 + 1, F.col("__n") - 1).alias("k")))).alias("__t")
    t = t.select(*keys, "q", (pos - F.floor(pos)).alias("__frac"), "__lo", "__hi", F.lit(0).cast("long").alias("__off"), which)
    t = cut_lineage(t.select(*keys, "q", "__frac", "__lo", "__hi", "__off", "__t.w", "__t.k"))
    tkeys = [*keys, "q", "w"]
    while True:
        open_ = t.filter("__lo < __hi")
        if open_.isEmpty():
            break
        side = open_.select(*[F.col(c).alias(f"__k_{c}") for c in keys], "q", "w", "k", "__frac", "__lo", "__hi", "__off")
        same = reduce(lambda a, b: a & b, [d[c].eqNullSafe(side[f"__k_{c}"]) for c in keys], F.lit(True))
        cand = d.join(side, same).filter(F.col("__v").between(F.col("__lo"), F.col("__hi")))
        cells = cand.groupBy(*tkeys, "k", "__frac", "__off", _cell(F.col("__v"), F.col("__lo"), F.col("__hi")).alias("__c")).agg(
            F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        # At most CELLS + 2 rows per target.
        w = Window.partitionBy(*tkeys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("__off") + F.coalesce(F.sum("__n").over(w), F.lit(0))
        hit = cells.withColumn("__start", start).filter(
            (F.col("k") >= F.col("__start")) & (F.col("k") < F.col("__start") + F.col("__n")))
        t = cut_lineage(t.filter("__lo >= __hi").unionByName(
            hit.withColumn("__off", F.col("__start")).select(*t.columns)))
    out = t.groupBy(*keys, "q").agg(F.max(F.when(F.col("w") == 1, F.col("__lo"))).alias("__x1"),
                                    F.max(F.when(F.col("w") == 2, F.col("__lo"))).alias("__x2"),
                                    F.first("__frac").alias("__frac"))
    exact = (F.col("__frac") == 0) | (F.col("__x1") == F.col("__x2"))  # also keeps infinities from meeting
    between = F.when(exact, F.col("__x1")).otherwise(
        F.col("__x1") + F.col("__frac") * (F.col("__x2") - F.col("__x1")))
    return out.select(*keys, "q", between.alias("value"))
