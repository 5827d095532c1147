import random

import pytest

from stayline.operators.windows import rolling_lookback


@pytest.mark.parametrize("hours", [0, 1, 4, 28])
def test_equals_brute_force(spark, hours):
    """Dense and sparse stays with NULL values, one without any, negative hours, and another column kept."""
    r = random.Random(hours)
    rows = [(s, h, None if s == 3 or r.random() < 0.4 else float(r.randrange(1000)), f"{s}:{h}")
            for s in range(5) for h in range(-3 if s == 4 else 0, 70) if s % 2 == 0 or r.random() < 0.3]
    d = spark.createDataFrame(rows, "stay int, hours_in long, x double, tag string")
    got = rolling_lookback(d.repartition(5), "stay", ["x"], hours, first=True)
    assert got.columns == ["stay", "hours_in", "x", "tag", "x_first", "x_last", "x_min", "x_max", "x_sum"]
    want = []
    for s, t, x, tag in rows:
        v = [y for q, h, y, _ in sorted(rows) if q == s and t - hours <= h <= t and y is not None]
        want.append((s, t, x, tag, *((v[0], v[-1], min(v), max(v)) if v else (None,) * 4), float(sum(v))))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_one_shuffle_whatever_the_windows(spark):
    d = spark.range(100).selectExpr("id % 3 stay", "id hours_in", "cast(id as double) x")
    plan = rolling_lookback(d, "stay", ["x"], 24)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "RangeFrame" not in plan.replace("specifiedwindowframe(RangeFrame, unbounded", "")
