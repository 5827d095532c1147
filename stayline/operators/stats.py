"""Summary statistics, reports and group comparisons.

Column-wise reports are computed as ONE aggregation over the table followed by
an unpivot of the single result row — never one job per column.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.operators.quantiles import exact_percentiles


def _unpivot_row(row_df: DataFrame, names: list[str], key: str, val: str) -> DataFrame:
    return row_df.unpivot([], names, key, val)


def completeness(wide: DataFrame, cols: dict[str, str]) -> DataFrame:
    """A10: round(count(col) / rows, 3) × 100 per variable."""
    row = wide.agg(*[(F.round(F.count(c) / F.count(F.lit(1)), 3) * 100).alias(v) for v, c in cols.items()])
    return _unpivot_row(row, list(cols), "variable", "pct")


def null_counts(wide: DataFrame, cols: dict[str, str]) -> DataFrame:
    """NULL count per column (``sum(isnull)``), long form."""
    row = wide.agg(*[F.count_if(F.col(c).isNull()).alias(v) for v, c in cols.items()])
    return _unpivot_row(row, list(cols), "variable", "n_null")


def share_more_than(wide: DataFrame, stay: str, cols: dict[str, str], ks=(1, 2, 3)) -> DataFrame:
    """Share of stays with more than k non-NULL values per column (strict ``> k``)."""
    per = wide.groupBy(stay).agg(*[F.count(c).alias(v) for v, c in cols.items()])
    lng = per.unpivot([stay], list(cols), "variable", "n")
    kk = F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")
    return (lng.select("variable", "n", kk).groupBy("variable", "k")
            .agg(F.avg(F.when(F.col("n") > F.col("k"), 1.0).otherwise(0.0)).alias("share")))


def variable_summary(long: DataFrame, grid: DataFrame) -> DataFrame:
    """Mean / std of hourly means and missing % over all grid hours."""
    n = grid.agg(F.count(F.lit(1)).alias("__n"))
    g = long.groupBy("variable").agg(F.avg("mean").alias("mean"), F.stddev_samp("mean").alias("std"),
                                     F.count("mean").alias("__m"))
    g = g.crossJoin(F.broadcast(n))  # single-row table
    return g.select("variable", "mean", "std", (F.lit(100.0) * (1 - F.col("__m") / F.col("__n"))).alias("missing_pct"))


def mean_by_hour(long: DataFrame) -> DataFrame:
    """Mean of the observed hourly means per (variable, hour)."""
    obs = F.col("count") > 0
    return long.groupBy("variable", "hours_in").agg(F.avg(F.when(obs, F.col("mean"))).alias("mean"),
                                                    F.count_if(obs).alias("n_stays"))


def mean_of_sums(df: DataFrame, stay: str, cols: list[str]) -> DataFrame:
    """``groupby(stay).sum().mean()``."""
    per = df.groupBy(stay).agg(*[F.sum(c).alias(c) for c in cols])
    return per.agg(*[F.avg(c).alias(c) for c in cols])


def profile(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """N, median, sample variance, bias-corrected skew, 99th percentile.

    Skew is pandas' adjusted Fisher-Pearson G1 = g1 · sqrt(n(n-1)) / (n-2),
    built from Spark's population ``skewness``.  Medians/quantiles are exact
    (interpolated) via the distributed selection in ``quantiles``."""
    d = df.filter(F.col(value).isNotNull())
    m = d.groupBy(*keys).agg(F.count(value).alias("n"), F.var_samp(value).alias("variance"),
                             F.skewness(value).alias("__g1"))
    n = F.col("n").cast("double")
    m = m.withColumn("skew", F.when(n > 2, F.col("__g1") * F.sqrt(n * (n - 1)) / (n - 2))).drop("__g1")
    q = exact_percentiles(d, keys, value, [0.5, 0.99])
    q = q.groupBy(*keys).agg(F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
                             F.max(F.when(F.col("q") == 0.99, F.col("value"))).alias("q99"))
    return m.join(q, keys, "left").select(*keys, "n", "median", "variance", "skew", "q99")


def outlier_study(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A17 share of rows with |x − median| > std (all rows in the denominator),
    A18 mean after replacing those — and NULLs — by the median."""
    st = df.groupBy(*keys).agg(F.stddev_samp(value).alias("__sd"))
    med = exact_percentiles(df.filter(F.col(value).isNotNull()), keys, value, [0.5]) \
        .select(*keys, F.col("value").alias("__med"))
    d = df.join(st.join(med, keys, "left"), keys, "left")
    out = F.abs(F.col(value) - F.col("__med")) > F.col("__sd")
    return d.groupBy(*keys).agg(
        F.avg(F.when(out, 1.0).otherwise(0.0)).alias("outlier_ratio"),
        F.avg(F.when(out, F.col("__med")).otherwise(F.coalesce(F.col(value), F.col("__med")))).alias("mean_replaced"))


def minmax_scale(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x − min) / (max − min) with global statistics (one-row broadcast)."""
    st = df.agg(*[F.min(c).alias(f"__lo_{c}") for c in cols], *[F.max(c).alias(f"__hi_{c}") for c in cols])
    d = df.crossJoin(F.broadcast(st))
    for c in cols:
        d = d.withColumn(c + suffix, (F.col(c) - F.col(f"__lo_{c}")) / (F.col(f"__hi_{c}") - F.col(f"__lo_{c}")))
    return d.drop(*[x for x in d.columns if x.startswith("__lo_") or x.startswith("__hi_")])


def standardize(df: DataFrame, cols: list[str], by: list[str] | None = None, train: DataFrame | None = None,
                suffix: str = "", ddof: int = 1) -> DataFrame:
    """(x − mean_train) / std_train; ``ddof=0`` gives the population std."""
    src = df if train is None else train
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = [F.avg(c).alias(f"__mu_{c}") for c in cols] + [sd(c).alias(f"__sd_{c}") for c in cols]
    if by:
        st = src.groupBy(*by).agg(*aggs)
        d = df.join(st, by, "left")
    else:
        d = df.crossJoin(F.broadcast(src.agg(*aggs)))
    for c in cols:
        d = d.withColumn(c + suffix, (F.col(c) - F.col(f"__mu_{c}")) / F.col(f"__sd_{c}"))
    return d.drop(*[x for x in d.columns if x.startswith("__mu_") or x.startswith("__sd_")])


def average_rank(df: DataFrame, col: str, name: str = "rank") -> DataFrame:
    """Pandas ``rank()`` — ties share the mean of their ranks.  Intended
    for small ranked sets (one row per feature/variable)."""
    w = Window.orderBy(col)
    peers = Window.partitionBy(col)
    return df.withColumn(name, F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0)


def crosstab_margins(df: DataFrame, row: str, col: str, measures: dict[str, str], label: str = "All") -> DataFrame:
    """Count and means by row category × column category with "All"
    margins on both axes (``pivot_table(margins=True)``) via CUBE."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"{m}") for m, c in measures.items()]
    cu = df.cube(row, col).agg(*aggs, F.grouping_id().alias("__gid"))
    r = F.when(F.col("__gid").bitwiseAND(2) == 2, F.lit(label)).otherwise(F.col(row))
    c = F.when(F.col("__gid").bitwiseAND(1) == 1, F.lit(label)).otherwise(F.col(col))
    return cu.select(r.alias(row), c.alias(col), "n", *measures.keys())


def group_moments(df: DataFrame, group: str, value: str, by: list[str] | None = None) -> DataFrame:
    """count / mean / sample variance per group — everything a t-test needs."""
    by = by or []
    return df.groupBy(*by, group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                      F.var_samp(value).alias("var"))


def ttest_ind(df: DataFrame, group: str, value: str, a, b, by: list[str] | None = None,
              with_p: bool = False) -> DataFrame:
    """Equal-variance two-sample t-test of ``value`` between group ``a`` and ``b``.

    One aggregation computes the moments; t and df are column expressions on
    the (tiny) per-comparison result.  ``with_p`` adds the two-sided p-value
    via an Arrow-batched pandas UDF over those few rows."""
    by = by or []
    m = group_moments(df.filter(F.col(group).isin(a, b)), group, value, by)
    pv = m.groupBy(*by).agg(
        *[F.max(F.when(F.col(group) == g, F.col(x))).alias(f"{x}_{s}")
          for g, s in ((a, "a"), (b, "b")) for x in ("n", "mean", "var")])
    pv = pv.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_a", "n_b")})  # a group without rows
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    sp2 = ((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b")) / (na + nb - 2)
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(sp2 * (1 / na + 1 / nb))
    out = pv.withColumn("t", t).withColumn("dof", (na + nb - 2))
    if with_p:
        from stayline.functions.tdist import t_two_sided_p_udf
        out = out.withColumn("p_value", t_two_sided_p_udf(F.col("t"), F.col("dof")))
    return out


def rate_report(df: DataFrame, flags: list[str]) -> DataFrame:
    """Count and share of rows with each 0/1 flag, long form."""
    n = F.count(F.lit(1))
    row = df.agg(n.alias("__n"), *[F.sum(F.col(f).cast("long")).alias(f) for f in flags])
    lng = row.unpivot(["__n"], flags, "flag", "n_flagged")
    return lng.select("flag", "n_flagged", (F.col("n_flagged") / F.col("__n") * 100.0).alias("pct"))
