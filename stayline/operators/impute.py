"""Layered imputation on the hourly grid (M06: W08, A22, F28, W09, M05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_means_from_long(long: DataFrame, variables: list[str], stay: list[str],
                           train: DataFrame | None = None) -> DataFrame:
    """Training-set mean of each variable's hourly means, read from the long
    (stay, variable, hour) table: its rows are exactly the non-NULL grid cells,
    so this equals the mean over the wide grid without a second pass over it."""
    src = long if train is None else long.join(train.select(*stay).distinct(), stay, "left_semi")
    return src.agg(*[F.avg(F.when(F.col("variable") == v, F.col("mean"))).alias(f"__g_{v}") for v in variables])


def simple_impute(wide: DataFrame, stay: list[str], variables: list[str],
                  train: DataFrame | None = None, final_fill: float | None = None,
                  absent_value: float = 100.0, global_means: DataFrame | None = None) -> DataFrame:
    """For each variable ``v`` (columns ``v_mean``, ``v_count``):

    * ``v_mean``: forward fill within the stay, then the stay mean, then the
      mean over training stays (``train``: stay keys; all stays if None);
    * ``v_mask``: 1.0 where ``v_count > 0``;
    * ``v_time_since_measured``: hours since the last measured hour of the
      same stay, ``absent_value`` before the first one (computed per stay; the
      source's running sum crosses stay borders).

    ``global_means`` (one row, columns ``__g_<v>``, e.g. from
    ``global_means_from_long``) avoids a second pass over ``wide``.
    """
    w_run = Window.partitionBy(*stay).orderBy("hours_in").rowsBetween(Window.unboundedPreceding, 0)
    w_stay = Window.partitionBy(*stay)
    if global_means is not None:
        gm = global_means
    else:
        src = wide if train is None else wide.join(train.select(*stay).distinct(), stay, "left_semi")
        gm = src.agg(*[F.avg(f"{v}_mean").alias(f"__g_{v}") for v in variables])
    out = wide.crossJoin(F.broadcast(gm))  # a single row of global means
    cols = [*stay, "hours_in"]
    for v in variables:
        m, c = F.col(f"{v}_mean"), F.col(f"{v}_count")
        filled = F.coalesce(F.last(m, ignorenulls=True).over(w_run), F.avg(m).over(w_stay), F.col(f"__g_{v}"))
        if final_fill is not None:
            filled = F.coalesce(filled, F.lit(float(final_fill)))
        mask = F.when(F.coalesce(c, F.lit(0)) > 0, 1.0).otherwise(0.0)
        last_seen = F.last(F.when(F.coalesce(c, F.lit(0)) > 0, F.col("hours_in")), ignorenulls=True).over(w_run)
        tsm = F.coalesce((F.col("hours_in") - last_seen).cast("double"), F.lit(absent_value))
        cols += [filled.alias(f"{v}_mean"), mask.alias(f"{v}_mask"), tsm.alias(f"{v}_time_since_measured")]
    return out.select(*cols)


def standardize_time_since(df: DataFrame, cols: list[str], absent_value: float = 100.0) -> DataFrame:
    """Time-since-measured columns with the 'never measured' marker set to
    0, then scaled by the population mean and std (numpy's ddof=0)."""
    d = df
    for c in cols:
        d = d.withColumn(c, F.when(F.col(c) == absent_value, 0.0).otherwise(F.col(c)))
    st = d.agg(*[F.avg(c).alias(f"__mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"__sd_{c}") for c in cols])
    d = d.crossJoin(F.broadcast(st))  # one-row table
    for c in cols:
        d = d.withColumn(c, (F.col(c) - F.col(f"__mu_{c}")) / F.col(f"__sd_{c}"))
    return d.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])
