"""Parquet table access for the provided data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SCANS: dict[tuple, DataFrame] = {}  # one scan DataFrame per (session, path)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    The same DataFrame object serves every read of a path in a session, so
    plans that read a table several times share one scan relation (and Spark
    can reuse its exchanges).  Scans are not repartitioned: measured on the
    provided single-row-group files, an extra round-robin shuffle per scan
    cost more than the parallelism it bought, and large tables split into
    many tasks on their own (``spark.sql.files.maxPartitionBytes``)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views so SQL text (S01/S02) can name the tables directly."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
