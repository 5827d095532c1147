"""Streaming forms agree with the batch operators."""

import os
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stayline.operators.sessions import gap_sessions
from stayline.streaming.jobs import gap_sessions_stream, hourly_bins_stream, run_to_table

T0 = datetime(2100, 1, 1)
SCHEMA = "stay long, ts timestamp, variable string, value double"


def _write(spark, rows):
    d = tempfile.mkdtemp(prefix="stayline-stream-")
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(os.path.join(d, "in"))
    return os.path.join(d, "in")


def test_stream_sessions_match_batch(spark):
    rows = [(1, T0 + timedelta(hours=h), "x", 1.0) for h in (0, 8, 16.5, 30, 31, 31.5)] + \
           [(2, T0 + timedelta(hours=h), "x", 1.0) for h in (0, 1, 20)] + \
           [(3, T0 + timedelta(hours=100), "x", 1.0)]  # advances the watermark past every session
    path = _write(spark, rows)
    stream = spark.readStream.schema(SCHEMA).parquet(path)
    got = run_to_table(spark, gap_sessions_stream(stream, "stay", "ts"), "sess_t")
    got = {(r.stay, r.starttime, r.endtime) for r in got.collect()}
    batch = gap_sessions(spark.read.parquet(path), "stay", "ts", None, 8.0)
    exp = {(r.stay, r.starttime, r.endtime) for r in batch.collect()}
    assert got == exp


def test_stream_hourly_bins(spark):
    rows = [(1, T0 + timedelta(minutes=m), "x", float(m)) for m in (5, 20, 70)] + \
           [(1, T0 + timedelta(hours=10), "x", 1.0)]
    path = _write(spark, rows)
    stream = spark.readStream.schema(SCHEMA).parquet(path)
    got = run_to_table(spark, hourly_bins_stream(stream, "stay", "ts", "variable", "value"), "bins_t")
    r = {row.hour_start: row for row in got.collect()}
    assert r[T0]["count"] == 2 and abs(r[T0]["mean"] - 12.5) < 1e-12
    assert r[T0 + timedelta(hours=1)]["count"] == 1
