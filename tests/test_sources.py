"""Sources and sinks (S05-S17) round-trip through a scratch folder."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stayline.operators.hourly import mean_only
from stayline.sources import files as FS
from stayline.sources.querier import restrict_to_cohort, run_sql
from stayline.sources.schema import check_constraints, conform, read_csv, schema_from_spec, write_csv

SPEC = {"fields": [{"name": "subject_id", "type": "integer", "constraints": {"required": True}},
                   {"name": "score", "type": "number"}, {"name": "n", "type": "integer"},
                   {"name": "name", "type": "string"}],
        "primaryKey": ["subject_id"]}


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="stayline-src-")


def test_schema_conform_and_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([(2, "b", 1.5), (1, "a", None)], "subject_id long, name string, score double")
    st = schema_from_spec(SPEC)
    out = conform(df, st, ["subject_id"])
    assert out.columns == ["subject_id", "score", "n", "name"]
    assert {r.n for r in out.collect()} == {0}                       # missing integer field filled with 0
    p = os.path.join(scratch, "static.csv")
    write_csv(df, p, st)
    back = read_csv(spark, p, st)
    assert sorted(r.subject_id for r in back.collect()) == [1, 2]
    rep = check_constraints(back, SPEC)
    assert rep == {"null_required": {"subject_id": 0}, "duplicate_keys": 0}
    with pytest.raises(ValueError):
        conform(df.drop("name"), st)                                 # missing string field is an error


def test_spec_file_and_keyed_store(spark, scratch):
    path = os.path.join(scratch, "spec.json")
    with open(path, "w") as fh:
        json.dump({"resources": [{"schema": SPEC}]}, fh)
    from stayline.sources.schema import load_spec
    assert load_spec(path)["primaryKey"] == ["subject_id"]
    df = spark.createDataFrame([(1, 2.0)], "k long, v double")
    FS.write_keyed(df, scratch, "patients")
    assert FS.read_keyed(spark, scratch, "patients").count() == 1
    calls = []

    def compute():
        calls.append(1)
        return df
    p = os.path.join(scratch, "reuse")
    FS.reuse_or_compute(spark, p, compute, mode=1)
    FS.reuse_or_compute(spark, p, compute, mode=1)                  # reloads, no recompute
    FS.reuse_or_compute(spark, p, compute, mode=2)                  # recomputes
    assert len(calls) == 2
    assert [r.name for r in FS.column_listing(spark, df).collect()] == ["k", "v"]


def test_reuse_notices_changes_and_broken_writes(spark, scratch):
    source, path = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    calls = []

    def ask(mode=1, params=None, fail=False):
        def compute():
            calls.append(1)
            d = spark.read.parquet(source).repartition(2)
            return d.withColumn("v", F.raise_error(F.lit("ended"))) if fail else d
        return FS.reuse_or_compute(spark, path, compute, mode, [source], params)

    spark.range(5).write.parquet(source)
    assert ask().count() == 5 and ask().count() == 5 and len(calls) == 1
    spark.range(7).write.mode("append").parquet(source)              # a changed input
    assert ask().count() == 12 and len(calls) == 2
    assert ask(params={"min": 1}).count() == 12 and len(calls) == 3  # a changed parameter
    ask(params={"min": 1})
    assert len(calls) == 3 and ask(0).count() == 12
    with pytest.raises(Exception):
        ask(params={"min": 2}, fail=True)                            # an ended write leaves nothing that counts
    assert ask(params={"min": 2}).count() == 12 and len(calls) == 5
    part = next(f for f in sorted(os.listdir(path)) if f.startswith("part-"))
    os.truncate(os.path.join(path, part), 10)                        # a damaged file
    assert ask(params={"min": 2}).count() == 12 and len(calls) == 6
    with open(os.path.join(path, FS.MANIFEST), "w") as fh:
        fh.write("{half")
    ask(params={"min": 2})
    assert len(calls) == 7
    spark.range(1).write.mode("overwrite").parquet(path)             # a table of other make
    assert ask(params={"min": 2}).count() == 12 and len(calls) == 8
    with pytest.raises(Exception):
        FS.reuse_or_compute(spark, path, lambda: None, 1, [os.path.join(scratch, "nowhere")])


def test_mapping_and_range_csv(spark, scratch):
    vm = os.path.join(scratch, "map.csv")
    with open(vm, "w") as fh:
        fh.write("ITEMID,LEVEL1,LEVEL2,COUNT,STATUS\n1,HR,heart rate,10,ready\n2,X,,5,ready\n3,Y,y,0,ready\n4,Z,z,3,pending\n")
    got = FS.variable_mapping(spark, vm).collect()
    assert [(r.ITEMID, r.LEVEL2) for r in got] == [(1, "heart rate")]
    rg = os.path.join(scratch, "ranges.csv")
    with open(rg, "w") as fh:
        fh.write("LEVEL2,OUTLIER LOW,VALID LOW,IMPUTE,VALID HIGH,OUTLIER HIGH\n"
                 "Heart Rate,0,1,80,300,350\nHeart Rate,5,5,5,5,5\nGlucose,0,1,,2,3\n")
    r = FS.variable_ranges(spark, rg).collect()
    assert [(x.VARIABLE, x.OUTLIER_LOW) for x in r] == [("heart rate", 0.0)]   # first row kept; NULL row dropped


def test_querier_and_cohort_restriction(spark):
    a = spark.createDataFrame([(1, 5), (2, 7)], "id long, v long")
    got = run_sql(spark, "SELECT id FROM IDENTIFIER(:t) WHERE v > :m", params={"t": "qa", "m": 6}, tables={"qa": a})
    assert [r.id for r in got.collect()] == [2]
    with pytest.raises(ValueError):
        run_sql(spark)
    cohort = spark.createDataFrame([(2,)], "id long")
    assert [r.id for r in restrict_to_cohort(a, cohort, ["id"]).collect()] == [2]


def test_mean_only_projection(spark):
    w = spark.createDataFrame([(1, 0, 1.0, 0.5, 2)], "s long, hours_in long, hr_mean double, hr_std double, hr_count long")
    assert mean_only(w).columns == ["s", "hours_in", "hr_mean"]


def test_report_and_sorted_sinks(spark, scratch):
    """S15, O02, P20."""
    from stayline.operators.hourly import lower_columns
    rows = [(2, 1, 5.0, "x"), (1, 2, None, "y"), (1, 1, 7.0, "z")]
    d = spark.createDataFrame(rows, "Stay long, HOUR int, b double, A string")
    low = lower_columns(d)
    assert low.columns == ["stay", "hour", "b", "a"]
    out = FS.sorted_output(low, ["stay", "hour"])
    assert out.columns == ["stay", "hour", "a", "b"]
    assert [tuple(r) for r in out.collect()] == [(1, 1, "z", 7.0), (1, 2, "y", None), (2, 1, "x", 5.0)]
    path = os.path.join(scratch, "summary")
    FS.write_summary_csv(low, path)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    back = spark.read.option("header", True).schema(low.schema).csv(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, low.collect()))
    FS.write_summary_csv(low.limit(0), path)
    assert spark.read.option("header", True).csv(path).count() == 0


def test_holdout_within_one_part(spark):
    """Only subjects of the part, about the share, whole subjects, alike in any partitioning."""
    from stayline.operators.splits import holdout_within
    d = spark.range(4000).select((F.col("id") % 2000).alias("s"), F.when(F.col("id") % 2000 < 1500, "train").otherwise("test").alias("part"))
    out = holdout_within(d, "s", "part", "train", 0.2)
    held = {r.s for r in out.filter("early_stop").collect()}
    assert max(held) < 1500 and 0.16 < len(held) / 1500 < 0.24
    assert out.filter("early_stop").count() == 2 * len(held)
    again = holdout_within(d.repartition(7), "s", "part", "train", 0.2)
    assert held == {r.s for r in again.filter("early_stop").collect()}
