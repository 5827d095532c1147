"""Windows over the dense stay-by-hour grid.

Grid windows are partitioned by stay: a stay has ``max_hours + 1`` grid rows
no matter how many raw measurements it holds, so these partitions are
bounded by stay duration and cannot be skewed by hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The transition-task label codes.
CHUNK_KEY = {"ONSET": 0, "CONTROL": 1, "ON_INTERVENTION": 2, "WEAN": 3}


def _adjacent(arr: Column, pred) -> Column:
    """exists i >= 1: pred(arr[i-1], arr[i]) (successive differences, W13)."""
    idx = F.sequence(F.lit(1), F.greatest(F.size(arr) - 1, F.lit(1)))
    return F.when(F.size(arr) < 2, F.lit(False)).otherwise(
        F.exists(idx, lambda i: pred(F.element_at(arr, i), F.element_at(arr, i + 1))))


def _cut(d: DataFrame, max_len: int | None) -> DataFrame:
    return d if max_len is None else d.filter(F.col("hours_in") < max_len)


def transition_labels(grid: DataFrame, stay: str, flag: str, slice_size: int = 6, gap: int = 6,
                      pred: int = 4, max_len: int | None = None, keep_window: bool = True,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Sliding samples with the ONSET / CONTROL / ON / WEAN label.

    Sample start t runs over ``range(length - slice - gap - pred)`` with
    ``length`` the stay's full hour count.  With ``max_len`` hours from there
    on are cut, so windows near the cut are truncated.  Rules in order: any change in the
    gap window drops the sample; a constant prediction window is CONTROL (0s)
    or ON (1s); a rise is ONSET; a fall is WEAN.  ``keep`` names columns of the
    start hour's row that come along."""
    w_all = Window.partitionBy(stay)
    d = grid.select(stay, "hours_in", F.col(flag).cast("int").alias("__y"), *keep)
    d = _cut(d.withColumn("__len", F.count(F.lit(1)).over(w_all)), max_len)
    w = Window.partitionBy(stay).orderBy("hours_in")
    x = F.collect_list("__y").over(w.rowsBetween(0, slice_size - 1))
    g = F.collect_list("__y").over(w.rowsBetween(slice_size, slice_size + gap - 1))
    p = F.collect_list("__y").over(w.rowsBetween(slice_size + gap, slice_size + gap + pred - 1))
    d = d.withColumn("__x", x).withColumn("__g", g).withColumn("__p", p)
    d = d.filter(F.col("hours_in") < F.col("__len") - (slice_size + gap + pred))
    gchange = _adjacent(F.col("__g"), lambda a, b: a != b)
    rise = _adjacent(F.col("__p"), lambda a, b: (b - a) == 1)
    fall = _adjacent(F.col("__p"), lambda a, b: (b - a) == -1)
    some_diff = F.size("__p") >= 2
    pmax = F.array_max("__p")
    label = (F.when(gchange, F.lit(None))
             .when(some_diff & ~rise & ~fall & (pmax == 0), F.lit(CHUNK_KEY["CONTROL"]))
             .when(some_diff & ~rise & ~fall & (pmax == 1), F.lit(CHUNK_KEY["ON_INTERVENTION"]))
             .when(rise, F.lit(CHUNK_KEY["ONSET"]))
             .when(fall, F.lit(CHUNK_KEY["WEAN"])))
    d = d.withColumn("label", label.cast("int")).filter(F.col("label").isNotNull())
    cols = [stay, F.col("hours_in").alias("start_hour"), "label"]
    if keep_window:
        cols.append(F.col("__x").alias("window"))
    return d.select(*cols, *keep)


def binary_labels(grid: DataFrame, stay: str, flag: str, slice_size: int = 6, gap: int = 6,
                  pred: int = 4, max_len: int | None = None) -> DataFrame:
    """Binary variant: drop when the gap window holds a 1, else label = max of prediction window."""
    w_all = Window.partitionBy(stay)
    d = grid.select(stay, "hours_in", F.col(flag).cast("int").alias("__y"))
    d = _cut(d.withColumn("__len", F.count(F.lit(1)).over(w_all)), max_len)
    w = Window.partitionBy(stay).orderBy("hours_in")
    d = d.withColumn("__gmax", F.max("__y").over(w.rowsBetween(slice_size, slice_size + gap - 1)))
    d = d.withColumn("__pmax", F.max("__y").over(w.rowsBetween(slice_size + gap, slice_size + gap + pred - 1)))
    d = d.filter(F.col("hours_in") < F.col("__len") - (slice_size + gap + pred))
    d = d.filter((F.col("__gmax") != 1) & F.col("__pmax").isNotNull())
    return d.select(stay, F.col("hours_in").alias("start_hour"), F.col("__pmax").alias("label"))


def rolling_lookback(grid: DataFrame, stay: str, cols: list[str], hours: int = 4, first: bool = False,
                     parted: bool = False) -> DataFrame:
    """Features over hours ``t-hours .. t`` at every row of ``grid`` (W11, J17):
    last non-NULL (with ``first`` the first one too), min, max and sum of each
    column.  ``grid`` has one row for a stay and hour, hours without a row
    being hours without values.

    The hours are cut into blocks of the window's length.  A window is the end
    of one block and the beginning of the next: running aggregates forwards
    give every beginning, running ones backwards every end, so the work does
    not grow with the length, as that of a sliding frame does.  A ``grid`` that
    is partitioned by stay, as the hourly one is, is not shuffled again with ``parted``."""
    size, other = hours + 1, [c for c in grid.columns if c not in (stay, "hours_in")]
    start = F.col("hours_in") - hours
    # A row as itself and, unless its window is a whole block, as a question at its window's start.
    ask = F.when(F.pmod(start, F.lit(size)) != 0, F.struct(F.lit(1).alias("ask"), start.alias("at")))
    own = F.struct(F.lit(0).alias("ask"), F.col("hours_in").alias("at"))
    d = grid.select(stay, "hours_in", *other, F.explode(F.filter(F.array(own, ask), lambda x: x.isNotNull())).alias("__r"))
    d = d.select("*", F.col("__r.ask").alias("__ask"), F.col("__r.at").alias("__at"),
                 F.floor(F.col("__r.at") / size).alias("__block")).drop("__r")
    d = d if parted else d.repartition(stay)  # serves the windows and the grouping; a stay has a row an hour at most
    to_here = (Window.unboundedPreceding, 0)
    fore = Window.partitionBy(stay, "__block").orderBy("__at", "__ask").rowsBetween(*to_here)
    back = Window.partitionBy(stay, "__block").orderBy(F.desc("__at"), "__ask").rowsBetween(*to_here)
    kinds = [*(["first"] if first else []), "last", "min", "max", "sum"]
    made, aggs = {}, []
    for c in cols:
        v = F.when(F.col("__ask") == 0, F.col(c))
        begin = {"first": F.first(v, ignorenulls=True), "last": F.last(v, ignorenulls=True)}
        end = {"first": begin["last"], "last": begin["first"]}  # running backwards
        both = {"min": F.min(v), "max": F.max(v), "sum": F.sum(v)}
        for k in kinds:
            made[f"__{c}_{k}"] = F.when(F.col("__ask") == 0, (begin | both)[k].over(fore)).otherwise((end | both)[k].over(back))
            b, e = (F.max(F.when(F.col("__ask") == x, F.col(f"__{c}_{k}"))) for x in (0, 1))
            joined = {"first": F.coalesce(e, b), "last": F.coalesce(b, e), "min": F.least(b, e), "max": F.greatest(b, e),
                      "sum": F.coalesce(b, F.lit(0.0)) + F.coalesce(e, F.lit(0.0))}[k]
            aggs.append(joined.alias(f"{c}_{k}"))
    d = d.withColumns(made).groupBy(stay, "hours_in").agg(
        F.max_by(F.struct(*other), -F.col("__ask")).alias("__row"), *aggs)
    return d.select(stay, "hours_in", *[F.col("__row").getField(c).alias(c) for c in other],
                    *[f"{c}_{k}" for c in cols for k in kinds])


def to_sequence(grid: DataFrame, stay: str, cols: list[str], max_len: int | None = None,
                pad: float = 0.0) -> DataFrame:
    """Per-stay ordered hour slices (X05); optional pad/truncate to ``max_len``."""
    row = F.struct(F.col("hours_in"), *[F.col(c) for c in cols])
    src = grid if max_len is None else grid.filter(F.col("hours_in") < max_len)  # never collect what is cut
    g = src.groupBy(stay).agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    def field(c):
        return lambda r: r.getField(c)
    out = g.select(stay, *[F.transform("__rows", field(c)).alias(c) for c in cols])
    if max_len is not None:
        for c in cols:
            padded = F.concat(F.col(c), F.array_repeat(F.lit(pad).cast("double"), F.lit(max_len)))
            out = out.withColumn(c, F.slice(padded, 1, max_len))
    return out


def sample_windows(grid: DataFrame, stay: str, cols: list[str], size: int = 6) -> DataFrame:
    """Per stay and start hour, the next ``size`` hourly values of each column
    as arrays (the X part of a sliding sample)."""
    w = Window.partitionBy(stay).orderBy("hours_in").rowsBetween(0, size - 1)
    # Collected as structs: a list of bare values would leave out NULL hours.
    rows = F.collect_list(F.struct(*cols)).over(w)

    def field(c):
        return F.transform("__rows", lambda r: r.getField(c)).alias(f"{c}_win")
    out = grid.select(stay, F.col("hours_in").alias("start_hour"), rows.alias("__rows"))
    return out.select(stay, "start_hour", *[field(c) for c in cols])


def one_hot_label(df: DataFrame, label: str, n_classes: int, prefix: str = "label_") -> DataFrame:
    """class id → indicator columns."""
    for k in range(n_classes):
        df = df.withColumn(f"{prefix}{k}", (F.col(label) == k).cast("int"))
    return df


def flatten_sample(static_cols: list[str], array_cols: list[str]) -> Column:
    """Static values once, then every windowed series, as one array."""
    parts = [F.array(*[F.col(c).cast("double") for c in static_cols])] + \
        [F.transform(F.col(c), lambda x: x.cast("double")) for c in array_cols]
    return F.concat(*parts)
