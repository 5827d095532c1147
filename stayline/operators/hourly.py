"""Hourly time series on the dense stay-by-hour grid.

Canonical form is long: one row per (stay, variable, hour) with mean / std /
count.  The wide form (``<variable>_<agg>`` columns on every grid hour) pivots
the measured hours alone, spread by stay over as many tasks as the grid has
hours for, and then fills the hours between them: grid hours are streamed out,
never hashed, sorted or shuffled, and there is no per-variable join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.numbers import nan_to_null, to_number
from stayline.functions.ranges import apply_variable_limits
from stayline.functions.timefns import floor_hours, hours_in
from stayline.functions.units import apply_unit_rules
from stayline.operators.dims import salted_join

ID_COLS = ["subject_id", "hadm_id", "icustay_id"]
ITEM_COLS = ["itemid", "label", "LEVEL1", "LEVEL2"]
AGGS = ("mean", "std", "count")
#: Grid hours that one task makes and holds; the number of tasks grows with the grid.
GRID_ROWS = 200_000


def with_max_hours(stays: DataFrame, intime: str = "intime", outtime: str = "outtime") -> DataFrame:
    """max_hours = floor((outtime - intime) / 1h); the grid is 0..max_hours inclusive."""
    return stays.withColumn("max_hours", floor_hours(intime, outtime))


def hour_grid(stays: DataFrame, id_cols=ID_COLS) -> DataFrame:
    """One row per (stay, hours_in) for hours 0..max_hours (X04 range_unnest).

    Rows per stay depend on its duration only, never on how many
    measurements it holds, so the explode cannot be skewed by hot stays."""
    s = stays if "max_hours" in stays.columns else with_max_hours(stays)
    s = s.filter(F.col("max_hours") >= 0)
    return s.select(*id_cols, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                   F.col("max_hours").cast("bigint"))).alias("hours_in"))


def spread_by_stay(rows: DataFrame, stays: DataFrame, id_cols=ID_COLS) -> DataFrame:
    """``rows`` with a column ``__last`` (NULL), and for each stay a row of NULLs
    whose ``__last`` is its last grid hour, spread by stay for ``fill_hours``.

    The number of tasks follows the number of grid hours, counted here by one
    job: the few rows of a stay become all its hours, so a partitioning by the
    size of these rows would put ever more of the grid into one task."""
    s = stays if "max_hours" in stays.columns else with_max_hours(stays)
    ends = s.filter(F.col("max_hours") >= 0).groupBy(*id_cols).agg(F.max("max_hours").cast("bigint").alias("__last"))
    hours = ends.agg(F.sum(F.col("__last") + 1)).first()[0] or 0
    u = rows.withColumn("__last", F.lit(None).cast("bigint")).unionByName(ends, allowMissingColumns=True)
    return u.repartition(max(1, -(-hours // GRID_ROWS)), *id_cols)


def fill_hours(rows: DataFrame, id_cols=ID_COLS) -> DataFrame:
    """``rows`` (one for a stay and hour, partitioned by ``spread_by_stay``) and,
    with NULLs, the hours of 0..``__last`` that have none.  Each row is followed
    by the hours up to the next one; a row without such a stay stays alone.  The
    result is still partitioned by stay, so windows over it need no shuffle."""
    w = Window.partitionBy(*id_cols).orderBy("hours_in", "__last")  # the row of the stay's end comes first
    d = rows.select("*", F.lead("hours_in").over(w).alias("__next"),
                    F.last("__last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__end"))
    none = F.array().cast("array<bigint>")
    start = F.greatest(F.coalesce(F.col("hours_in"), F.lit(-1)) + 1, F.lit(0))
    stop = F.least(F.col("__next") - 1, F.col("__end"))  # no next row: to the end
    gap = F.when(F.col("__end").isNotNull() & (stop >= start), F.sequence(start, stop)).otherwise(none)
    own = F.when(F.col("__last").isNull(), F.array(F.col("hours_in"))).otherwise(none)
    d = d.select("*", F.explode(F.concat(own, gap)).alias("__hour"))
    here = F.col("__hour").eqNullSafe(F.col("hours_in"))
    values = [c for c in rows.columns if c not in (*id_cols, "hours_in", "__last")]
    return d.select(*id_cols, F.col("__hour").alias("hours_in"), *[F.when(here, F.col(f"`{c}`")).alias(c) for c in values])


def join_hours(left: DataFrame, right: DataFrame, id_cols=ID_COLS) -> DataFrame:
    """Inner join on stay and hour of two grids, each with one row for a stay
    and hour and columns of its own.

    A join would shuffle both by (stay, hour), into ``spark.sql.shuffle.partitions``
    parts however many hours there are, and windows would shuffle the result back
    by stay.  The rows are put under each other and grouped instead: grids that
    ``spread_by_stay`` laid out alike stay in their parts."""
    keys = [*id_cols, "hours_in"]
    u = left.withColumn("__side", F.lit(1)).unionByName(right.withColumn("__side", F.lit(2)), allowMissingColumns=True)
    cols = [c for c in (*left.columns, *right.columns) if c not in keys]
    g = u.groupBy(*keys).agg(F.min("__side").alias("__l"), F.max("__side").alias("__r"),
                             *[F.max(F.col(f"`{c}`")).alias(c) for c in cols])
    return g.filter("__l < __r").dropna(subset=keys).select(*keys, *[f"`{c}`" for c in cols])


def prepare_measurements(X: DataFrame, stays: DataFrame, var_map: DataFrame | None = None,
                         items: DataFrame | None = None, var_ranges: DataFrame | None = None,
                         apply_units: bool = True, apply_var_limit: bool = True,
                         id_cols=ID_COLS, stay_key: str = "icustay_id",
                         time_col: str = "charttime") -> DataFrame:
    """Coerce values, place them in hours of stay, map items to variables,
    standardise units and clean ranges.

    ``X``: ids, ``charttime``, ``itemid``, ``value`` (text or number), ``valueuom``.
    ``stays``: ids, ``intime``, ``outtime``.  ``var_map``: ITEMID, LEVEL1, LEVEL2.
    ``items``: itemid, label.  Output keeps hours inside the grid only.
    """
    vtype = dict(X.dtypes)["value"]
    val = to_number("value") if vtype == "string" else nan_to_null(F.col("value").cast("double"))
    keep = [c for c in X.columns if c not in ("intime", "max_hours", "value")]
    s = stays if "max_hours" in stays.columns else with_max_hours(stays)
    s = s.select(stay_key, F.col("intime").alias("__intime"), "max_hours")
    x = salted_join(X.select(*keep, val.alias("value")), s, stay_key, [time_col, "itemid"])
    cols = keep + ["value", "hours_in"]
    x = (x.select(*keep, "value", "max_hours", hours_in("__intime", time_col).alias("hours_in"))
         .filter(F.col("hours_in") <= F.col("max_hours")))
    if var_map is not None:
        vm = var_map.select(F.col("ITEMID").cast("string").alias("__vm_item"), "LEVEL1", "LEVEL2")
        x = x.join(vm, F.col("itemid").cast("string") == F.col("__vm_item"), "left")
        cols += ["LEVEL1", "LEVEL2"]
    if items is not None:
        it = items.select(F.col("itemid").cast("string").alias("__it_item"), "label")
        x = x.join(it, F.col("itemid").cast("string") == F.col("__it_item"), "left")
        cols += ["label"]
    x = x.select(*cols)
    if apply_units and var_map is not None:
        unit = "valueuom" if "valueuom" in keep else None
        x = apply_unit_rules(x, "value", "LEVEL1", unit)
    if apply_var_limit and var_ranges is not None:
        x = apply_variable_limits(x, var_ranges, "LEVEL2", "value")
    return x


def variable_key(group_by_level2: bool = True):
    """Name of a measurement's variable: LEVEL2, or itemid|label|LEVEL1|LEVEL2."""
    if group_by_level2:
        return F.col("LEVEL2")
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ITEM_COLS])


def _keys_present(group_by_level2: bool):
    cols = ["LEVEL2"] if group_by_level2 else ITEM_COLS
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def hourly_long(M: DataFrame, group_by_level2: bool = True, id_cols=ID_COLS) -> DataFrame:
    """mean / sample std / count per (stay, variable, hour).

    NULL group keys are dropped (unmapped items), single observations give a
    NULL std.  The measurements come from a salted join, so every stay is
    aggregated in parts before the shuffle on (stay, variable, hour)."""
    m = M.filter(_keys_present(group_by_level2)).withColumn("variable", variable_key(group_by_level2))
    return (m.groupBy(*id_cols, "variable", "hours_in")
            .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                 F.count("value").alias("count")))


def hourly_wide(M: DataFrame, stays: DataFrame, variables: list[str],
                group_by_level2: bool = True, id_cols=ID_COLS) -> DataFrame:
    """Dense wide table: every grid hour, ``<v>_mean``, ``<v>_std``, ``<v>_count``.

    The long aggregate (one row per stay, variable and hour) is pivoted in one
    grouped aggregation on (stay, hour): Spark's pivot indexes each row's
    variable into its slot (constant work per row, whatever the number of
    variables).  Hours without data are filled in with NULLs and counts of 0
    (J14 + F30) without a reindex join."""
    return long_to_wide(hourly_long(M, group_by_level2, id_cols), stays, variables, id_cols)


def long_to_wide(long: DataFrame, stays: DataFrame, variables: list[str], id_cols=ID_COLS) -> DataFrame:
    u = long.select(*id_cols, F.col("hours_in").cast("bigint").alias("hours_in"), "variable", "mean", "std", "count")
    w = (spread_by_stay(u, stays, id_cols).groupBy(*id_cols, "hours_in", "__last").pivot("variable", list(variables))
         .agg(F.first("mean").alias("mean"), F.first("std").alias("std"), F.first("count").alias("count")))
    w = fill_hours(w, id_cols)
    cols = [*id_cols, "hours_in"]
    for v in variables:
        cols += [F.col(f"`{v}_mean`").alias(f"{v}_mean"), F.col(f"`{v}_std`").alias(f"{v}_std"),
                 F.coalesce(F.col(f"`{v}_count`"), F.lit(0).cast("bigint")).alias(f"{v}_count")]
    return w.select(*cols)


def sparse_variable_stats(long: DataFrame, grid: DataFrame, min_percent: float) -> DataFrame:
    """Per variable: NULL-mean cells on the grid and the drop decision.

    Threshold n = round_half_even((1 - min_percent/100) * grid_rows); a
    variable is dropped when its NULL-mean count exceeds n."""
    n_rows = grid.agg(F.count(F.lit(1)).alias("n_rows"))
    per_var = long.groupBy("variable").agg(F.count("mean").alias("n_mean"))
    d = per_var.crossJoin(F.broadcast(n_rows))  # one-row table
    thr = F.bround(F.lit(1.0 - min_percent / 100.0) * F.col("n_rows"), 0)
    return d.select("variable", "n_rows", (F.col("n_rows") - F.col("n_mean")).alias("n_null"),
                    thr.cast("bigint").alias("threshold"),
                    ((F.col("n_rows") - F.col("n_mean")) <= thr).alias("keep"))


def drop_sparse(wide: DataFrame, stats: DataFrame) -> DataFrame:
    """Remove the columns of variables marked ``keep = false``.

    The column set is data dependent, so the (tiny, one row per variable)
    decision table is read on the driver to choose the projection."""
    drop = [r["variable"] for r in stats.filter(~F.col("keep")).select("variable").collect()]
    cols = [c for c in wide.columns if not any(c.startswith(v + "_") and c[len(v) + 1:] in AGGS for v in drop)]
    return wide.select(*cols)


def mean_only(wide: DataFrame) -> DataFrame:
    """vitals_labs_mean: keep only the ``_mean`` columns."""
    return wide.select(*[c for c in wide.columns if not (c.endswith("_std") or c.endswith("_count"))])


def save_numerics(stays: DataFrame, X: DataFrame, items: DataFrame | None, var_map: DataFrame,
                  var_ranges: DataFrame | None, variables: list[str] | None = None,
                  group_by_level2: bool = True, apply_var_limit: bool = True,
                  min_percent: float = 0.0, id_cols=ID_COLS) -> DataFrame:
    """End-to-end D02: the dense wide hourly table with sparse columns dropped."""
    if stays.isEmpty() or X.isEmpty():
        raise ValueError("Must provide some input data to process.")
    s = with_max_hours(stays)
    M = prepare_measurements(X, s, var_map, items, var_ranges,
                             apply_var_limit=apply_var_limit, id_cols=id_cols)
    if variables is None:
        # The column set is the variables present in the data (as a pivot
        # would give); the distinct key set is bounded by the item dictionary.
        variables = sorted(r[0] for r in M.filter(_keys_present(group_by_level2))
                           .select(variable_key(group_by_level2)).distinct().collect())
    wide = hourly_wide(M, s, variables, group_by_level2, id_cols)
    if min_percent > 0:
        stats = sparse_variable_stats(hourly_long(M, group_by_level2, id_cols), hour_grid(s, id_cols), min_percent)
        wide = drop_sparse(wide, stats)
    return wide


def lower_columns(df: DataFrame) -> DataFrame:
    """P20: lower-case every column label."""
    return df.toDF(*[c.lower() for c in df.columns])
