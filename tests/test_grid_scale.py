"""The dense grid is made in tasks of bounded size: its hours are streamed out
of rows spread by stay, however few those rows are."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stayline.operators import hourly as H
from stayline.operators.intervals import hourly_indicators_from
from stayline.operators.windows import rolling_lookback

T0 = datetime(2100, 1, 1)
LONG = "stay long, variable string, hours_in long, mean double, std double, count long"


def _stays(spark, n=40, hours=49):
    rows = [(i, T0, T0 + timedelta(hours=hours)) for i in range(n)]
    return H.with_max_hours(spark.createDataFrame(rows, "stay long, intime timestamp_ntz, outtime timestamp_ntz"))


def _largest_part(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def _above_explode(df):
    """The plan from the top down to the hours' explode."""
    return df._jdf.queryExecution().executedPlan().toString().split("Generate explode")[0]


def test_wide_grid_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(H, "GRID_ROWS", 200)
    s = _stays(spark)
    long = spark.createDataFrame([(i, "a", i, 1.0 * i, None, 1) for i in range(40)], LONG)
    wide = H.long_to_wide(long, s, ["a", "b"], ["stay"])
    assert wide.count() == 40 * 50
    assert _largest_part(wide) <= 4 * 200
    assert "Aggregate" not in _above_explode(wide) and "Exchange" not in _above_explode(wide)


def test_gaps_nulls_repeats_and_strangers(spark):
    ends = [(1, 3), (1, 3), (2, 1), (2, 2), (None, 1), (3, -1), (4, 0)]  # stays 1 and 2 come twice
    s = spark.createDataFrame([(k, h) for k, h in ends], "stay long, max_hours long")
    long = spark.createDataFrame([(1, "a", 0, 1.0, 0.5, 2), (1, "b", 2, 2.0, None, 1), (1, None, 3, 9.0, None, 1),
                                  (2, "a", 1, 3.0, None, 1), (None, "b", 1, 4.0, None, 1),
                                  (9, "a", 5, 5.0, None, 1), (9, "b", 7, 6.0, None, 1)], LONG)  # 9 has no stay
    rows = H.long_to_wide(long, s, ["a", "b"], ["stay"]).collect()
    got = {(r.stay, r.hours_in): (r.a_mean, r.a_std, r.a_count, r.b_mean, r.b_count) for r in rows}
    empty = (None, None, 0, None, 0)
    want = {(1, 0): (1.0, 0.5, 2, None, 0), (1, 1): empty, (1, 2): (None, None, 0, 2.0, 1), (1, 3): empty,
            (2, 0): empty, (2, 1): (3.0, None, 1, None, 0), (2, 2): empty,
            (None, 0): empty, (None, 1): (None, None, 0, 4.0, 1), (4, 0): empty,
            (9, 5): (5.0, None, 1, None, 0), (9, 7): (None, None, 0, 6.0, 1)}
    assert got == want and len(rows) == len(want)


def test_indicators_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(H, "GRID_ROWS", 200)
    s = _stays(spark)
    spans = spark.createDataFrame([(i, i % 5, i % 5 + 20, "on") for i in range(40)] * 3 + [(0, 7, 7, "dot")],
                                  "stay long, __from long, __to long, __iv string")
    g = hourly_indicators_from(s, "stay", spans, ["on", "dot"])
    got = {(r.stay, r.hours_in): (r.on, r.dot) for r in g.collect()}
    assert got == {(i, h): (int(i % 5 <= h <= i % 5 + 20), int((i, h) == (0, 7))) for i in range(40) for h in range(50)}
    assert g.count() == 40 * 50 and _largest_part(g) <= 4 * 200


def test_lookback_keeps_the_grids_parts(spark, monkeypatch):
    monkeypatch.setattr(H, "GRID_ROWS", 200)
    long = spark.createDataFrame([(i, "a", i, 1.0 * i, None, 1) for i in range(40)], LONG)
    wide = H.long_to_wide(long, _stays(spark), ["a"], ["stay"])
    out = rolling_lookback(wide.select("stay", "hours_in", "a_mean"), "stay", ["a_mean"], 4, parted=True)
    assert out.count() == 40 * 50 and _largest_part(out) <= 4 * 200
    assert "Exchange" not in _above_explode(out)
