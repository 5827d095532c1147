"""Skew-safe ordered-window primitives for raw event streams.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task, so a key holding a third of all rows becomes one giant sorted task.
These helpers split each key by a coarse time bucket: the row-level window
runs per (key, bucket) and only a one-row-per-bucket summary is ordered per
key.  Rows with equal timestamps always share a bucket, so ties (and RANGE
frames over peers) behave exactly like the single-partition window.

Windows over the dense stay-by-hour grid do not need this: a stay's grid has
``max_hours + 1`` rows however many measurements it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.timefns import time_bucket

DEFAULT_BUCKET_SECONDS = 3600
_B = "__bucket"


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _with_bucket_rows(d: DataFrame, per_bucket: DataFrame, keys: list[str]) -> DataFrame:
    """``d`` with the columns of its (key, bucket) row; a NULL key or time is a
    key or bucket like any other, as it is to a window."""
    on = [*keys, _B]
    r = per_bucket.select(*[F.col(c).alias(f"__on_{i}") for i, c in enumerate(on)],
                          *[c for c in per_bucket.columns if c not in on])
    cond = F.lit(True)
    for i, c in enumerate(on):
        cond = cond & d[c].eqNullSafe(r[f"__on_{i}"])
    return d.join(r, cond, "left").drop(*[f"__on_{i}" for i in range(len(on))])


def with_bucket(df: DataFrame, ts: str, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    return df.withColumn(_B, time_bucket(ts, bucket_seconds))


def lag_within(df: DataFrame, keys: list[str], ts: str, cols: list[str],
               tiebreak: list[str] | None = None, prefix: str = "prev_",
               descending: bool = False,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``prefix+c`` = value of ``c`` on the previous row of the key in
    (ts, *tiebreak) order (``descending=True`` gives the next row, i.e. LEAD)."""
    tiebreak = tiebreak or []
    order = [ts] + tiebreak
    order_cols = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    d = with_bucket(df, ts, bucket_seconds)
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    w_in = Window.partitionBy(*keys, _B).orderBy(*order_cols)
    d = d.withColumn("__in_prev", F.lag(payload).over(w_in))

    # One row per (key, bucket): the bucket's last row in the chosen order.
    sort_key = F.struct(*[F.col(c) for c in order])
    pick = F.max_by(payload, sort_key) if not descending else F.min_by(payload, sort_key)
    last = d.groupBy(*keys, _B).agg(pick.alias("__last"))
    wb = Window.partitionBy(*keys).orderBy(F.col(_B).desc() if descending else F.col(_B).asc())
    last = last.withColumn("__bucket_prev", F.lag("__last").over(wb)).drop("__last")

    out = _with_bucket_rows(d, last, keys)
    prev = F.coalesce(F.col("__in_prev"), F.col("__bucket_prev"))
    for c in cols:
        out = out.withColumn(prefix + c, prev.getField(c))
    return out.drop("__in_prev", "__bucket_prev", _B)


def dense_rank_within(df: DataFrame, keys: list[str], ts: str, name: str = "rank",
                      bucket_seconds: int = 86400) -> DataFrame:
    """DENSE_RANK() OVER (PARTITION BY keys ORDER BY ts), split by time bucket.

    Rank = dense rank inside the bucket + number of distinct ``ts`` values of
    the key in earlier buckets."""
    d = with_bucket(df, ts, bucket_seconds)
    w_in = Window.partitionBy(*keys, _B).orderBy(F.col(ts))
    d = d.withColumn("__r_in", F.dense_rank().over(w_in))
    per_b = d.groupBy(*keys, _B).agg(
        (F.count_distinct(ts) + F.max(F.col(ts).isNull().cast("int"))).alias("__nd"))  # NULL is a value of its own
    wb = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.withColumn("__off", F.coalesce(F.sum("__nd").over(wb), F.lit(0))).drop("__nd")
    out = _with_bucket_rows(d, per_b, keys)
    return out.withColumn(name, (F.col("__r_in") + F.col("__off")).cast("int")).drop("__r_in", "__off", _B)


def row_number_within(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str],
                      name: str = "rn", descending: bool = False,
                      bucket_seconds: int = 86400) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ts, *tiebreak), split by bucket."""
    d = with_bucket(df, ts, bucket_seconds)
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in [ts] + tiebreak]
    d = d.withColumn("__r_in", F.row_number().over(Window.partitionBy(*keys, _B).orderBy(*order)))
    per_b = d.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("__n"))
    wb = (Window.partitionBy(*keys).orderBy(F.col(_B).desc() if descending else F.col(_B).asc())
          .rowsBetween(Window.unboundedPreceding, -1))
    per_b = per_b.withColumn("__off", F.coalesce(F.sum("__n").over(wb), F.lit(0))).drop("__n")
    out = _with_bucket_rows(d, per_b, keys)
    return out.withColumn(name, (F.col("__r_in") + F.col("__off")).cast("int")).drop("__r_in", "__off", _B)


def scan_agg_within(df: DataFrame, keys: list[str], ts: str, value: str, agg: str = "min",
                    following: bool = True, tiebreak: list[str] | None = None, name: str = "scan",
                    bucket_seconds: int = 86400) -> DataFrame:
    """For every row, ``agg`` (min or max) of ``value`` over the rows of the
    same key strictly after it (``following``) or strictly before it in
    (ts, *tiebreak) order — e.g. "earliest end among stays that start after
    this one ends".  Rows with a NULL ``value`` act as pure queries.

    The in-bucket part is a window over (key, bucket); the rest combines the
    per-bucket aggregates of later (earlier) buckets, so no key is ever
    ordered in a single task."""
    tiebreak = tiebreak or []
    fn = {"min": F.min, "max": F.max}[agg]
    comb = {"min": F.least, "max": F.greatest}[agg]
    # "Strictly after in ascending order" is "strictly before in descending
    # order": always use a growing (UNBOUNDED PRECEDING .. -1) frame, which
    # Spark evaluates incrementally; an UNBOUNDED FOLLOWING frame would be
    # recomputed for every row (quadratic in the partition size).
    def order(cols):
        return [F.col(c).desc() if following else F.col(c).asc() for c in cols]
    d = with_bucket(df, ts, bucket_seconds)
    w = Window.partitionBy(*keys, _B).orderBy(*order([ts] + tiebreak))
    d = d.withColumn("__in", fn(value).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    per_b = d.groupBy(*keys, _B).agg(fn(value).alias("__bagg"))
    wb = Window.partitionBy(*keys).orderBy(*order([_B])).rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.withColumn("__across", fn("__bagg").over(wb)).drop("__bagg")
    out = _with_bucket_rows(d, per_b, keys)
    return out.withColumn(name, comb(F.col("__in"), F.col("__across"))).drop("__in", "__across", _B)


def _count_below(cuts: Column, v: Column) -> Column:
    """How many elements of the sorted array ``cuts`` are less than ``v``; a NULL is below all."""
    step = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        less = (s["lo"] < s["hi"]) & (F.get(cuts, mid) < v)
        return F.struct(F.when(less, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(less | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 2)).cast("int"))
    return F.when(v.isNull(), 0).otherwise(F.aggregate(rounds, step, halve, lambda s: s["lo"]))


def global_cumsum(df: DataFrame, order_cols: list[str], sum_cols: dict[str, str],
                  num_partitions: int | None = None, inclusive: bool = True) -> DataFrame:
    """Running sums over a total order of the whole table, without a single-
    task window.  Rows are cut into value ranges of the first order column
    (boundaries from ``percentile_approx``: at most n-1 numbers, read once and
    frozen as literals), each range is summed, the per-range totals become
    offsets, and a running sum inside each range finishes the job.  A row's
    range is a pure function of the row, so both uses of the ranged rows and
    any recomputed task (e.g. after an executor loss) agree on it.
    ``sum_cols`` maps output name → column to sum; rows tied on the whole
    order should be pre-aggregated (ties have no defined order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    first = order_cols[0]
    if n > 1:
        probs = [i / n for i in range(1, n)]
        # A sketch's result can depend on merge order, so it is read once and
        # frozen; n-1 numbers, bounded by the partition count.
        cuts = df.agg(F.percentile_approx(first, probs, 10000)).first()[0] or []
        arr = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
        # Binary search in the sorted cuts: how many lie below the value.
        d = df.withColumn("__pid", _count_below(arr, F.col(first)))
    else:
        d = df.withColumn("__pid", F.lit(0))
    tot = d.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{o}") for o, c in sum_cols.items()])
    wo = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # over n rows only
    off = tot.select("__pid", *[F.coalesce(F.sum(f"__t_{o}").over(wo), F.lit(0)).alias(f"__o_{o}")
                                for o in sum_cols])
    d = d.join(F.broadcast(off), "__pid", "left")  # one row per range
    wp = Window.partitionBy("__pid").orderBy(*order_cols)
    wp = wp.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    for o, c in sum_cols.items():
        d = d.withColumn(o, F.col(f"__o_{o}") + F.coalesce(F.sum(c).over(wp), F.lit(0)))
    return d.drop("__pid", *[f"__o_{o}" for o in sum_cols])


def global_row_number(df: DataFrame, order_cols: list[str], name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order_cols) for the whole table, distributed."""
    d = df.withColumn("__one", F.lit(1).cast("long"))
    return global_cumsum(d, order_cols, {name: "__one"}, num_partitions).drop("__one")
