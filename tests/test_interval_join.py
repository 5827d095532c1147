import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayline.operators.interval_join import events_in_windows, hot_key_cuts

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data(spark):
    """Key 1 has a third of all events, a fifth of these at one instant; windows
    of all lengths, several a key; NULLs, repeats and windows that end early."""
    r = random.Random(3)
    events = [(1 if i % 3 == 0 else i % 40, T0 + dt.timedelta(seconds=r.randrange(0, 500_000))) for i in range(3000)]
    events += [(1, T0 + dt.timedelta(hours=50))] * 250 + [(None, T0), (5, None), (77, T0), (3, T0), (3, T0)]
    windows = []
    for k in [*range(45), None]:
        for _ in range(r.randrange(0, 4)):
            a = T0 + dt.timedelta(seconds=r.randrange(-1000, 500_000))
            windows.append((k, a, a + dt.timedelta(seconds=r.choice([0, 60, 7200, 90_000, 400_000]))))
    at = T0 + dt.timedelta(hours=50)
    windows += [(1, T0, T0 + dt.timedelta(days=9)), (1, at, at), (1, at + dt.timedelta(seconds=1), at), (3, T0, T0),
                (3, T0, T0), (4, None, at), (4, T0, None), (1, at - dt.timedelta(hours=1), at)]
    e = spark.createDataFrame([(i, *x) for i, x in enumerate(events)], "id int, k int, ts timestamp_ntz")
    w = spark.createDataFrame([(i, *x) for i, x in enumerate(windows)], "wid int, k int, a timestamp_ntz, b timestamp_ntz")
    want = sorted((i, j) for i, (k, t) in enumerate(events) for j, (q, a, b) in enumerate(windows)
                  if k is not None and k == q and t is not None and a is not None and b is not None and a <= t <= b)
    return e.repartition(9), w, want


@pytest.mark.parametrize("target", [None, 40, 100, 1000])
def test_equals_all_pairs(data, target):
    e, w, want = data
    d = events_in_windows(e, w, "k", "ts", "a", "b", target)
    assert d.columns.count("k") == 1 and set(d.columns) == {"k", "id", "ts", "wid", "a", "b"}
    assert sorted((r.id, r.wid) for r in d.select("id", "wid").collect()) == want


def test_cuts_are_bounded_and_repeat_a_full_instant(data):
    e, _, _ = data
    cuts = {r[0]: r[1] for r in hot_key_cuts(e, "k", "ts", 100).collect()}
    n = {r[0]: r[1] for r in e.filter("k IS NOT NULL AND ts IS NOT NULL").groupBy("k").count().collect()}
    assert set(cuts) == {k for k, c in n.items() if c > 100} and 1 in cuts
    assert all(len(c) == -(-n[k] // 100) - 1 and c == sorted(c) for k, c in cuts.items())
    assert len(cuts[1]) > len(set(cuts[1]))


def test_a_hot_key_spreads_over_tasks(spark, data):
    """Events of the key with a third of them all meet their windows in many tasks, none with most of them."""
    e, w, _ = data
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = w.filter("wid >= 0").groupBy("k").agg(F.min("a").alias("a"), F.max("b").alias("b"))
        d = events_in_windows(e, wide, "k", "ts", "a", "b", 50).filter("k = 1")
        rows = [r[0] for r in d.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
        plan = d._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) >= 6 and max(rows) < 0.4 * sum(rows)
    assert "hashpartitioning(k" in plan and "__bin" in plan and "CartesianProduct" not in plan


def test_empty_sides(data):
    e, w, _ = data
    assert events_in_windows(e.limit(0), w, "k", "ts", "a", "b", 10).count() == 0
    assert events_in_windows(e, w.limit(0), "k", "ts", "a", "b", 10).count() == 0
