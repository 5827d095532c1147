"""Events inside the time windows of their key.

An equi-join on the key alone puts all events of a key into one task.  Here
the events of a *hot* key (more than ``target`` of them) are cut into bins of
about ``target`` events by quantiles of their own times; a window is copied
into the bins that it overlaps, an event stands in one bin, and the join is on
(key, bin) plus the window's bounds.  Each pair thus comes out once, in the bin
of its later start, which is the event's.  Where one instant holds more than a
bin's worth, the quantiles repeat it; its events are spread over those bins by
a hash and the windows copied into all of them.

A key that is not hot has one bin, so its windows are not copied.  With
``target`` a fixed share of all events there are at most 1 / share hot keys
and twice as many bins, whatever the data's size; that bounds the broadcast
table of cuts.  It is checkpointed, so that both sides and any repeated task
see the same cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.timefns import epoch_us
from stayline.operators.ordered import _count_below
from stayline.session import cut_lineage

#: Bins that all events are cut into, per shuffle partition, and the least number of events worth a bin.
BINS_PER_PARTITION = 4
LEAST_TARGET = 10_000
_BIN, _CUTS = "__bin", "__cuts"


def hot_key_cuts(events: DataFrame, key: str, ts: str, target: int | None = None) -> DataFrame | None:
    """(key, __cuts): ascending times in microseconds that cut the events of
    each key with more than ``target`` of them; None if there is no such key."""
    spark = events.sparkSession
    sizes = events.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total, most = sizes.agg(F.sum("__n"), F.max("__n")).first()
    bins = BINS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = target or max(LEAST_TARGET, -(-(total or 0) // bins))
    if not most or most <= target:
        return None
    hot = sizes.filter(F.col("__n") > target)  # at most total / target keys
    k = -(-most // target)
    probs = [i / k for i in range(1, k)]
    cuts = (events.select(F.col(key), epoch_us(ts).alias("__us")).join(F.broadcast(hot), key)
            .groupBy(key).agg(F.max("__n").alias("__n"), F.percentile_approx("__us", probs, 10_000).alias("__all")))
    # A key with fewer events than the hottest one keeps every so manyth cut.
    own = F.ceil(F.col("__n") / target).cast("int")
    thinned = F.transform(F.sequence(F.lit(1), own - 1),
                          lambda i: F.get("__all", F.greatest(F.round(i * k / own).cast("int"), F.lit(1)) - 1))
    return cut_lineage(cuts.select(key, thinned.alias(_CUTS)))


def _at_most(cuts: Column, us: Column) -> Column:
    return _count_below(cuts, us + 1)


def events_in_windows(events: DataFrame, windows: DataFrame, key: str, ts: str, start: str, end: str,
                      target: int | None = None) -> DataFrame:
    """Inner join of ``events`` and ``windows`` on ``key`` where ``ts`` lies in
    [``start``, ``end``], both ends included; all columns of both, the key
    once.  NULL keys, times or bounds match nothing; a window that ends before
    it starts holds nothing; repeated rows give repeated pairs."""
    cuts = hot_key_cuts(events, key, ts, target)
    inside = F.col(ts).between(F.col(start), F.col(end))
    windows = windows.filter(F.col(start) <= F.col(end))
    if cuts is None:
        return events.join(windows, key).filter(inside)
    us = epoch_us(ts)
    e = events.join(F.broadcast(cuts), key, "left")
    low, high = _count_below(F.col(_CUTS), us), _at_most(F.col(_CUTS), us)
    e = e.withColumns({"__low": low, "__high": high})
    home = F.col("__low") + F.pmod(F.xxhash64(*events.columns),
                                   F.col("__high") - F.col("__low") + 1).cast("int")
    e = e.withColumn(_BIN, F.when(F.col(_CUTS).isNull(), 0).otherwise(home)).drop(_CUTS, "__low", "__high")
    w = windows.join(F.broadcast(cuts), key, "left")
    covered = F.sequence(_count_below(F.col(_CUTS), epoch_us(start)), _at_most(F.col(_CUTS), epoch_us(end)))
    w = w.withColumn(_BIN, F.explode(F.when(F.col(_CUTS).isNull(), F.array(F.lit(0))).otherwise(covered))).drop(_CUTS)
    return e.join(w, [key, _BIN]).filter(inside).drop(_BIN)
