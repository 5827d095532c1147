"""Boundary fixtures for operators the reference never tests (FIXTURES A4)."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayline.functions.categorize import age_band_strict, categorize_ethnicity
from stayline.functions.numbers import to_number
from stayline.functions.units import standardize_units
from stayline.operators.asof import asof_backward
from stayline.operators.cohort import readmission_30
from stayline.operators.hourly import hour_grid, with_max_hours
from stayline.operators.impute import simple_impute
from stayline.operators.intervals import hourly_indicators, interval_hours
from stayline.operators.sessions import gap_sessions
from stayline.operators.windows import transition_labels

T0 = datetime(2100, 1, 1)


def h(x):
    return T0 + timedelta(hours=x)


def test_gap_sessions_boundaries(spark):
    rows = [(1, h(0), 1), (1, h(8), 1),                 # gap exactly 8 h: same session
            (1, h(16) + timedelta(seconds=1), 1),       # 8 h + 1 s: new single-point session -> dropped
            (1, h(30), 1), (1, h(31), 1), (1, h(30.5), 0),  # flag 0 ignored
            (2, h(0), 0), (2, h(1), 0)]                  # never flagged
    df = spark.createDataFrame(rows, "stay long, ts timestamp_ntz, flag int")
    for b in (60, 3600, 86400):
        out = {(r.stay, r.session_no): (r.starttime, r.endtime) for r in gap_sessions(df, "stay", "ts", "flag", 8.0, b).collect()}
        assert out == {(1, 1): (h(0), h(8)), (1, 2): (h(30), h(31))}, b


def test_interval_expansion(spark):
    stays = spark.createDataFrame([(1, h(0), h(5)), (2, h(0), h(3))], "stay long, intime timestamp_ntz, outtime timestamp_ntz")
    iv = spark.createDataFrame([(1, h(1), h(2.5)), (1, h(2), h(3)), (1, h(5), h(5)), (1, h(4), h(6))],
                               "stay long, starttime timestamp_ntz, endtime timestamp_ntz")
    s = with_max_hours(stays)
    grid = hour_grid(s, ["stay"])
    out = hourly_indicators(grid, "stay", {"on": interval_hours(iv, s, "stay", "on")})
    got = {(r.stay, r.hours_in): r.on for r in out.collect()}
    assert [got[(1, i)] for i in range(6)] == [0, 1, 1, 1, 0, 1]  # overlap counted once; end outside stay dropped
    assert [got[(2, i)] for i in range(4)] == [0, 0, 0, 0]        # stay without intervention


def brute_readmission(stays, days=30):
    out = {}
    for d in stays:
        flag = 0
        later = [e for e in stays if e[0] == d[0] and e[2] > d[3]]
        if later:
            m = min(e[3] for e in later)
            for c in stays:
                if c[0] == d[0] and c[1] > d[1] and c[2] - d[3] <= timedelta(days=days) and c[3] == m:
                    flag = 1
        out[d[1]] = flag
    return out


def test_readmission_rules(spark):
    stays = [(1, 10, h(0), h(24)), (1, 11, h(24 + 30 * 24), h(24 + 31 * 24)),   # exactly 30 days later
             (2, 20, h(0), h(10)), (2, 21, h(20), h(30)), (2, 22, h(40), h(50)),  # two later stays
             (3, 31, h(0), h(10)), (3, 30, h(20), h(30))]                        # lower id later in time
    rnd = random.Random(5)
    for i in range(200):
        s = rnd.randint(4, 9)
        a = rnd.randint(0, 2000)
        stays.append((s, 100 + i, h(a), h(a + rnd.choice([0, 5, 24, 48, 300]))))
    df = spark.createDataFrame(stays, "subject_id long, icustay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    got = {r.icustay_id: r.readmission_30 for r in readmission_30(df).collect()}
    exp = brute_readmission(stays)
    assert got == exp
    assert got[10] == 1 and got[20] == 1 and got[21] == 1 and got[31] == 0


def test_asof_against_brute_force(spark):
    rnd = random.Random(1)
    left = [(i, rnd.randint(1, 3), h(rnd.uniform(0, 48))) for i in range(150)] + [(999, 1, None)]
    right = [(rnd.randint(1, 3), h(rnd.uniform(0, 48)), float(rnd.randint(0, 5))) for _ in range(300)]
    right.append((1, left[0][2] - timedelta(hours=2), 77.0))  # exactly at the tolerance
    L = spark.createDataFrame(left, "id long, k long, t timestamp_ntz")
    R = spark.createDataFrame(right, "k long, t timestamp_ntz, v double")
    got = {r.id: (r.r_t, r.r_v) for r in asof_backward(L, R, ["k"], "t", "t", 7200, ["v"], "r_", ["v"]).collect()}
    fine = {r.id: (r.r_t, r.r_v) for r in asof_backward(L, R, ["k"], "t", "t", 7200, ["v"], "r_", ["v"], 1700).collect()}
    assert fine == got
    for i, k, t in left:
        if t is None:
            assert got[i] == (None, None)
            continue
        c = [(rt, v) for kk, rt, v in right if kk == k and t - timedelta(hours=2) <= rt <= t]
        assert got[i] == (max(c) if c else (None, None)), i


def test_transition_label_cases(spark):
    def labels(seq):
        g = spark.createDataFrame([(1, i, v) for i, v in enumerate(seq)], "stay long, hours_in long, y int")
        return {r.start_hour: r.label for r in transition_labels(g, "stay", "y", keep_window=False).collect()}
    assert set(labels([0] * 20).values()) == {1}               # constant 0 -> CONTROL
    assert set(labels([1] * 20).values()) == {2}               # constant 1 -> ON
    # samples t = 0..3 look at hours t+12..t+15; a change in hours t+6..t+11 drops t
    assert labels([0] * 14 + [1] * 6) == {0: 0, 1: 0, 2: 2}        # onset, then on
    assert labels([1] * 14 + [0] * 6) == {0: 3, 1: 3, 2: 1}        # wean, then control
    assert labels([0] * 13 + [1, 0] + [0] * 5) == {0: 0, 1: 3}     # rise and fall: onset wins
    assert labels([0] * 15) == {}                               # shorter than 17 h: no sample


def test_imputation_layers(spark):
    rows = [(1, 0, None, 0), (1, 1, 2.0, 1), (1, 2, None, 0), (1, 3, 4.0, 1),
            (2, 0, None, 0), (2, 1, None, 0)]
    w = spark.createDataFrame(rows, "stay long, hours_in long, x_mean double, x_count long")
    out = {(r.stay, r.hours_in): r for r in simple_impute(w, ["stay"], ["x"]).collect()}
    assert out[(1, 0)].x_mean == 3.0 and out[(1, 2)].x_mean == 2.0     # leading gap -> stay mean; ffill
    assert out[(2, 0)].x_mean == 3.0                                    # never measured in stay -> global
    assert out[(1, 0)].x_time_since_measured == 100.0 and out[(1, 2)].x_time_since_measured == 1.0
    assert out[(1, 3)].x_mask == 1.0 and out[(1, 2)].x_mask == 0.0
    train = spark.createDataFrame([(2,)], "stay long")                  # never measured in train
    assert simple_impute(w, ["stay"], ["x"], train=train).filter("stay = 2").first().x_mean is None


def test_unit_rules(spark):
    rows = [("Fraction Inspired Oxygen", None, 50.0), ("Fraction Inspired Oxygen", None, 0.5),
            ("Oxygen saturation", None, 0.97), ("Oxygen saturation", None, 97.0),
            ("Temperature", None, 98.6), ("Temperature", "F", 36.0), ("Temperature", None, 36.6),
            ("Weight", None, None), ("Weight", "lbs", float("nan"))]
    df = spark.createDataFrame(rows, "name string, unit string, v double")
    got = [r[0] for r in df.select(standardize_units(F.col("v"), F.col("name"), F.col("unit"))).collect()]
    assert got[0] == 0.5 and got[1] == 0.5 and got[2] == 97.0 and got[3] == 97.0
    assert abs(got[4] - 37.0) < 1e-9 and abs(got[5] - (36.0 - 32) * 5 / 9) < 1e-9 and got[6] == 36.6
    assert got[7] is None


def test_number_coercion(spark):
    vals = [" 5 ", "5 mg", "5d", "nan", "inf", "", "1e3", "-.5", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(to_number("s")).collect()]
    assert got[0] == 5.0 and got[1] is None and got[2] is None and got[3] is None
    assert got[4] == math.inf and got[5] is None and got[6] == 1000.0 and got[7] == -0.5 and got[8] is None


def test_categorisers(spark):
    df = spark.createDataFrame([("WHITE - ASIAN",), (None,), ("HISPANIC",)], "e string")
    assert [r[0] for r in df.select(categorize_ethnicity("e")).collect()] == ["ASIAN", "OTHER", "HISPANIC/LATINO"]
    ages = spark.createDataFrame([(45.0,), (65.0,), (90.0,), (50.0,)], "a double")
    assert [r[0] for r in ages.select(age_band_strict("a")).collect()] == [None, None, None, "45-65"]


def test_age_buckets(spark):
    from stayline.functions.categorize import categorize_age
    df = spark.createDataFrame([(a,) for a in (5.0, 10.0, 10.5, 30.0, 30.5, 50.0, 51.0, 70.0, 70.5)], "a double")
    assert [r[0] for r in df.coalesce(1).select(categorize_age("a")).collect()] == [
        ">70", ">70", "<31", "<31", "31-50", "31-50", "51-70", "51-70", ">70"]


def test_group_rules_in_match_order(spark):
    from stayline.functions import categorize as C
    cases = [(C.MARITAL_RULES, {"SINGLE": C.ALONE, "WIDOWED": C.ALONE, "DIVORCED": C.ALONE, "SEPARATED": C.ALONE,
                                "LIFE PARTNER": "MARRIED", "MARRIED": "MARRIED", "": "OTHER", None: "OTHER", "single": "OTHER"}),
             (C.INSURANCE_RULES, {"Government": "GOVERNMENT", "Private": "PRIVATE", "Self Pay": "SELF PAY",
                                  "Medicare": "MEDICARE/MEDICAID", "Medicaid": "MEDICARE/MEDICAID", None: "OTHER"}),
             (C.ADMISSION_LOCATION_RULES, {"PHYS REFERRAL/NORMAL DELI": "REFERRAL", "EMERGENCY ROOM ADMIT": "EMERGENCY",
                                           "TRANSFER FROM SKILLED NUR": "TRANSFER", "TRSF WITHIN THIS FACILITY": "TRANSFER",
                                           "EMERGENCY REFERRAL": "REFERRAL", "** INFO NOT AVAILABLE **": "OTHER"}),
             (C.DIAGNOSIS_RULES, {"UROSEPSIS;FEVER": "SEPSIS", "FEVER": "OTHER", None: "OTHER"})]
    for rules, want in cases:
        d = spark.createDataFrame([(k,) for k in want], "t string")
        assert {r.t: r.g for r in d.select("t", C.by_rules("t", rules).alias("g")).collect()} == want


def test_window_ends_before_death_and_censoring(spark):
    from stayline.functions.hashing import uniform
    from stayline.plans.features_plans import random_times
    rows = [(1, 40.0, None, None), (2, 40.0, 30.5, None), (3, 40.0, 46.0, 10.0), (4, 40.0, 46.5, 10.0), (5, 40.0, 4.0, None),
            (6, 40.0, None, 12.0), (7, 40.0, None, 50.0), (8, 3.0, None, None)]
    st = spark.createDataFrame(rows, "s long, end double, death double, censor double")
    u = {r.s: r.u for r in st.select("s", uniform(111, "s").alias("u")).collect()}
    got = {r.s: r.t for r in random_times(st, "s", "end", "death", censor_hours="censor", t_to_death=6.0).collect()}
    assert (got[2], got[3], got[5]) == (24.5, 40.0, -2.0)     # six hours before death, also of deaths up to 6 h after the end
    assert got[4] == int(u[4] * 10) and got[6] == int(u[6] * 12)  # later deaths and others: drawn, up to censoring
    assert got[1] == int(u[1] * 40) and got[7] == int(u[7] * 40)
    plain = {r.s: r.t for r in random_times(st, "s", "end", "death", t_before=6.0).collect()}
    assert plain[8] == 0 and plain[2] == int(u[2] * 24.5)
    with pytest.raises(ValueError):
        random_times(st, "s", "end", t_to_death=6.0)
