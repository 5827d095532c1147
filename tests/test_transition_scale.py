"""The transition model's table: made where the stays' hours are, equal samples
of a stay kept once on disk, in parts that grow in number with the samples."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayline.functions.hashing import uniform
from stayline.operators import hourly as H
from stayline.operators import models as MD
from stayline.operators.dims import local_dim
from stayline.operators.windows import transition_labels
from stayline.plans import model_plans as MP
from stayline.plans import more_plans as RP

T0 = datetime(2100, 1, 1)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = []
    for user in range(60):
        for _ in range(25):
            kind = rng.choice(["click", "purchase", "view", "error", "signup"])
            rows.append((len(rows), T0 + timedelta(minutes=rng.randrange(6000)), user, kind, round(rng.uniform(1, 90), 2), "x"))
    rows.append((len(rows), T0, None, "click", 5.0, "x"))
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{path}/events.parquet")
    return path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grids_joined_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(H, "GRID_ROWS", 200)
    s = spark.createDataFrame([(i, 49) for i in range(40)], "stay long, max_hours long")
    long = spark.createDataFrame([(i, v, i, 1.0 * i, None, 1) for i in range(40) for v in "ab"],
                                 "stay long, variable string, hours_in long, mean double, std double, count long")
    a, b = (H.long_to_wide(long, s, [v], ["stay"]).select("stay", "hours_in", f"{v}_mean") for v in "ab")
    g = H.join_hours(a, b, ["stay"])
    assert "Exchange" not in _plan(g).split("Generate explode")[0]
    assert max(r["count"] for r in g.groupBy(F.spark_partition_id()).count().collect()) <= 4 * 200
    want = {(i, h): (1.0 * i, 1.0 * i) if i == h else (None, None) for i in range(40) for h in range(50)}
    assert {(r.stay, r.hours_in): (r.a_mean, r.b_mean) for r in g.collect()} == want and g.count() == len(want)


def test_join_hours_is_an_inner_join(spark):
    a = spark.createDataFrame([(1, 0, 5), (1, 1, None), (2, 0, 7), (None, 0, 8)], "stay long, hours_in long, x int")
    b = spark.createDataFrame([(1, 0, None), (1, 1, 2.5), (3, 0, 1.0), (None, 0, 2.0)], "stay long, hours_in long, y double")
    assert sorted(map(tuple, H.join_hours(a, b, ["stay"]).collect())) == [(1, 0, 5, None), (1, 1, None, 2.5)]


def test_samples_leave_the_hours_in_their_parts(spark, sf, monkeypatch):
    monkeypatch.setattr(H, "GRID_ROWS", 300)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(MP.q_transition_samples(spark, sf))
        assert not re.search(r"Exchange hashpartitioning\(user_id#\d+L?, (hours_in|start_hour)#", plan)
        assert "Exchange" not in plan.split("Generate explode")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_parameter_table_is_broadcast(spark):
    d = local_dim(spark, [("a", 1.5, None), ("b", None, 2)], "k string, x double, n int")
    assert d.dtypes == [("k", "string"), ("x", "double"), ("n", "int")]
    assert sorted(map(tuple, d.collect())) == [("a", 1.5, None), ("b", None, 2)]
    rows = spark.range(100).select(F.when(F.col("id") % 2 == 0, "a").otherwise("c").alias("key"))
    j = rows.join(d, F.col("key") == F.col("k"), "left")
    assert "BroadcastHashJoin" in _plan(j) and "SortMergeJoin" not in _plan(j)
    assert j.filter("x = 1.5").count() == 50 and j.count() == 100
    assert local_dim(spark, [], "k string").count() == 0


def test_labels_bring_columns_along(spark):
    g = spark.createDataFrame([(1, h, int(h >= 14), 10 * h) for h in range(20)], "stay long, hours_in long, y int, z int")
    plain = transition_labels(g, "stay", "y", keep_window=False).collect()
    kept = transition_labels(g, "stay", "y", keep_window=False, keep=("z",)).collect()
    assert [tuple(r) + (10 * r.start_hour,) for r in plain] == [tuple(r) for r in kept] and plain


def test_counted_rows_stand_for_equal_ones(spark):
    rng = random.Random(6)
    rows = [(float(y := rng.randrange(2)), float(rng.randrange(2)), p := rng.randrange(11) / 10, 1 - p, rng.randrange(1, 5))
            for _ in range(40)]
    d = spark.createDataFrame(rows, "label double, prediction double, p0 double, p1 double, n long")
    d = VectorAssembler(inputCols=["p0", "p1"], outputCol="probability").transform(d)
    each = MD.each_time(d, "n")
    assert "n" not in each.columns and each.count() == sum(r[4] for r in rows)
    assert MD.class_report(d, count="n").collect() == MD.class_report(each).collect()
    weights = [{tuple(r) for r in x.select("label", "weight").distinct().collect()}
               for x in (MD.class_weights(d, "label", count="n"), MD.class_weights(each, "label"))]
    assert weights[0] == weights[1]


def test_transition_model_of_single_samples(spark, sf, monkeypatch):
    s = MP.q_transition_samples(spark, sf).withColumn("label", F.col("label").cast("double"))
    s = s.withColumn("features", array_to_vector(F.transform("features", lambda x: F.coalesce(x, F.lit(0.0)))))
    s = s.withColumn("test", uniform(31, "user_id") < 0.3).persist()
    model = MD.fit_multiclass(MD.class_weights(s.filter("NOT test"), "label"), "label", "weight")
    want = MD.class_report(model.transform(s.filter("test")), "label").collect()
    samples = s.count()
    s.unpersist()

    seen, weighted, levels = [], MD.class_weights, []
    keep = type(s).persist
    monkeypatch.setattr(type(s), "persist", lambda self, *a, **k: levels.append(a[0] if a else None) or keep(self, *a, **k))
    monkeypatch.setattr(MD, "class_weights", lambda d, *a, **k: seen.append(d) or weighted(d, *a, **k))
    monkeypatch.setattr(RP.MP, "_local", lambda df: seen.append(seen[0].agg(F.count("n"), F.sum("n")).first()) or df)
    monkeypatch.setattr(RP, "SAMPLES", 400)
    got = RP.q_transition_model(spark, sf).collect()
    assert levels == [StorageLevel.DISK_ONLY]
    assert [r["class"] for r in got] == [r["class"] for r in want] and [r["n"] for r in got] == [r["n"] for r in want]
    for a, b in zip(got, want):
        assert all(abs(x - y) < 1e-3 for x, y in zip(tuple(a)[2:], tuple(b)[2:]))
    rows, held = seen[1]
    assert rows < held < samples and held + want[-1]["n"] == samples
