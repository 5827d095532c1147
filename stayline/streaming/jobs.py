"""Streaming hourly bins and gap sessions.

Both use event-time watermarks so state is bounded: a bin or a session is
emitted once the watermark passes its end, then dropped from the state store.
Checkpoints go under the session's shared ``spark.checkpoint.dir`` so a
restarted query (or a lost executor) resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import ensure_checkpoint_dir


def hourly_bins_stream(events: DataFrame, stay: str, ts: str, variable: str, value: str,
                       lateness: str = "2 hours") -> DataFrame:
    """A01 per clock hour: mean / sample std / count per (stay, variable, hour
    window).  Equals the batch hours-since-entry bins when stays start on the hour."""
    v = F.when(~F.isnan(F.col(value)), F.col(value))
    return (events.withWatermark(ts, lateness)
            .groupBy(stay, variable, F.window(ts, "1 hour").alias("w"))
            .agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.count(v).alias("count"))
            .select(stay, variable, F.col("w.start").alias("hour_start"), "mean", "std", "count"))


def gap_sessions_stream(events: DataFrame, stay: str, ts: str, gap: str = "8 hours",
                        lateness: str = "1 hour") -> DataFrame:
    """W04 with ``session_window``: a gap of exactly ``gap`` keeps one session,
    as in the batch rule; single-point sessions are dropped on output."""
    s = (events.withWatermark(ts, lateness)
         .groupBy(stay, F.session_window(ts, gap).alias("sw"))
         .agg(F.min(ts).alias("starttime"), F.max(ts).alias("endtime"), F.count(F.lit(1)).alias("n_points")))
    return s.filter(F.col("starttime") != F.col("endtime")).select(stay, "starttime", "endtime", "n_points")


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drain everything available (``availableNow``) into an in-memory table and
    return it; checkpoint state lives in the shared checkpoint folder."""
    ckpt = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{name}"
    q = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)
