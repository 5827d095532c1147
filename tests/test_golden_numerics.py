"""The reference's ten golden cases for the hourly aggregation (FIXTURES A2)."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stayline.operators.hourly import save_numerics

NAN = None
INTIME, OUTTIME = datetime(2100, 10, 1, 0, 0), datetime(2100, 10, 1, 5, 0)
RANGE_SCHEMA = "VARIABLE string, OUTLIER_LOW double, VALID_LOW double, IMPUTE double, VALID_HIGH double, OUTLIER_HIGH double"


def t(hhmm):
    h, m = hhmm.split(":")
    return datetime(2100, 10, 1, int(h), int(m))


def build(spark, rows, items):
    # Tolerance follows numpy.isclose defaults, as the source comparison does.
    """rows: (itemid, time, value, unit); items: itemid -> (label, level1, level2)."""
    X = spark.createDataFrame(
        [(1, 1, 1, t(tm), str(i), v, u) for i, tm, v, u in rows],
        "subject_id long, hadm_id long, icustay_id long, charttime timestamp_ntz, itemid string, value string, valueuom string")
    I = spark.createDataFrame([(str(i), lab, "TEST", "TEST", "TEST", "N/A") for i, (lab, _, _) in items.items()],
                              "itemid string, label string, dbsource string, linksto string, category string, unitname string")
    vm = spark.createDataFrame([(l2, l1, str(i)) for i, (_, l1, l2) in items.items()],
                               "LEVEL2 string, LEVEL1 string, ITEMID string")
    data = spark.createDataFrame([(1, 1, 1, INTIME, OUTTIME)],
                                 "icustay_id long, subject_id long, hadm_id long, intime timestamp_ntz, outtime timestamp_ntz")
    return data, X, I, vm


def default_ranges(spark):
    return spark.createDataFrame([], RANGE_SCHEMA)


def check(out, var, count, mean, std):
    rows = {r["hours_in"]: r for r in out.orderBy("hours_in").collect()}
    assert sorted(rows) == list(range(6))
    for h in range(6):
        r = rows[h]
        assert r[f"{var}_count"] == count[h], (var, h)
        for name, exp in (("mean", mean[h]), ("std", std[h])):
            got = r[f"{var}_{name}"]
            if exp is None:
                assert got is None, (var, name, h, got)
            else:
                assert got is not None and abs(got - exp) <= 1e-8 + 1e-5 * abs(exp), (var, name, h, got)


def test_empty_input_raises(spark):
    data, X, I, vm = build(spark, [], {1: ("test", "test_level1", "test_level2")})
    with pytest.raises(ValueError):
        save_numerics(data, X, I, vm, default_ranges(spark))


def case1(spark):
    rows = [(1, "01:15", "3", "m"), (1, "01:35", "5", "m"), (1, "03:35", "6", "m")]
    return build(spark, rows, {1: ("test", "test_level1", "test_level2")})


def test_multiple_observations_grouped(spark):
    data, X, I, vm = case1(spark)
    out = save_numerics(data, X, I, vm, default_ranges(spark))
    check(out, "test_level2", [0, 2, 0, 1, 0, 0], [NAN, 4, NAN, 6, NAN, NAN], [NAN, math.sqrt(2), NAN, NAN, NAN, NAN])


def test_multiple_observations_ungrouped(spark):
    data, X, I, vm = case1(spark)
    out = save_numerics(data, X, I, vm, default_ranges(spark), group_by_level2=False)
    check(out, "1|test|test_level1|test_level2", [0, 2, 0, 1, 0, 0], [NAN, 4, NAN, 6, NAN, NAN],
          [NAN, math.sqrt(2), NAN, NAN, NAN, NAN])


def outlier_case(spark):
    rows = [(1, "01:15", "0", "m"), (1, "01:35", "2", "m"), (1, "03:35", "5", "m"),
            (1, "03:50", "12", "m"), (1, "04:10", "18", "m")]
    data, X, I, vm = build(spark, rows, {1: ("test", "test_level1", "test_level2")})
    ranges = spark.createDataFrame([("test_level2", 1.0, 3.0, None, 10.0, 15.0)], RANGE_SCHEMA)
    return data, X, I, vm, ranges


def test_range_cleaning_off(spark):
    data, X, I, vm, ranges = outlier_case(spark)
    out = save_numerics(data, X, I, vm, ranges, apply_var_limit=False)
    check(out, "test_level2", [0, 2, 0, 2, 1, 0], [NAN, 1, NAN, 8.5, 18, NAN],
          [NAN, math.sqrt(2), NAN, math.sqrt(24.5), NAN, NAN])


def test_range_cleaning_on(spark):
    data, X, I, vm, ranges = outlier_case(spark)
    out = save_numerics(data, X, I, vm, ranges, apply_var_limit=True)
    check(out, "test_level2", [0, 1, 0, 2, 0, 0], [NAN, 3, NAN, 7.5, NAN, NAN],
          [NAN, NAN, NAN, math.sqrt(12.5), NAN, NAN])


def two_var_case(spark):
    rows = [(1, "01:15", "3", "m"), (2, "01:35", "5", "m"), (3, "01:25", "6", "m")]
    return build(spark, rows, {1: ("eyes", "eyes", "face"), 2: ("nose", "nose", "face"), 3: ("arms", "arms", "body")})


def test_two_variables_grouped(spark):
    data, X, I, vm = two_var_case(spark)
    out = save_numerics(data, X, I, vm, default_ranges(spark))
    check(out, "body", [0, 1, 0, 0, 0, 0], [NAN, 6, NAN, NAN, NAN, NAN], [NAN] * 6)
    check(out, "face", [0, 2, 0, 0, 0, 0], [NAN, 4, NAN, NAN, NAN, NAN], [NAN, math.sqrt(2), NAN, NAN, NAN, NAN])


def test_two_variables_ungrouped(spark):
    data, X, I, vm = two_var_case(spark)
    out = save_numerics(data, X, I, vm, default_ranges(spark), group_by_level2=False)
    for key, m in (("1|eyes|eyes|face", 3), ("2|nose|nose|face", 5), ("3|arms|arms|body", 6)):
        check(out, key, [0, 1, 0, 0, 0, 0], [NAN, m, NAN, NAN, NAN, NAN], [NAN] * 6)


def test_sparse_columns_dropped(spark):
    rows = [(1, "01:15", "3", "m"), (1, "02:35", "5", "m"), (3, "01:25", "6", "m")]
    data, X, I, vm = build(spark, rows, {1: ("eyes", "eyes", "face"), 3: ("arms", "arms", "body")})
    out = save_numerics(data, X, I, vm, default_ranges(spark), min_percent=30)
    assert not any(c.startswith("body_") for c in out.columns)
    check(out, "face", [0, 1, 1, 0, 0, 0], [NAN, 3, 5, NAN, NAN, NAN], [NAN] * 6)


def unit_case(spark):
    rows = [(1, "01:15", "35.274", "oz"), (1, "03:35", "352.74", "oz"), (3, "01:35", "10", "kg")]
    return build(spark, rows, {1: ("weight_oz", "weight", "weight"), 3: ("weight_kg", "weight", "weight")})


def test_unit_conversion_grouped(spark):
    data, X, I, vm = unit_case(spark)
    out = save_numerics(data, X, I, vm, default_ranges(spark))
    check(out, "weight", [0, 2, 0, 1, 0, 0], [NAN, 5.5, NAN, 10, NAN, NAN], [NAN, math.sqrt(40.5), NAN, NAN, NAN, NAN])


def test_unit_conversion_ungrouped(spark):
    data, X, I, vm = unit_case(spark)
    out = save_numerics(data, X, I, vm, default_ranges(spark), group_by_level2=False)
    check(out, "1|weight_oz|weight|weight", [0, 1, 0, 1, 0, 0], [NAN, 1, NAN, 10, NAN, NAN], [NAN] * 6)
    check(out, "3|weight_kg|weight|weight", [0, 1, 0, 0, 0, 0], [NAN, 10, NAN, NAN, NAN, NAN], [NAN] * 6)
