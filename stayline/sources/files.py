"""Keyed table store, dimension CSVs and reuse-or-compute."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_keyed(df: DataFrame, root: str, key: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """``to_hdf(file, key)`` → parquet folder ``root/key``."""
    path = f"{root.rstrip('/')}/{key}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_keyed(spark: SparkSession, root: str, key: str) -> DataFrame:
    """``read_hdf(file, key)``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{key}")


def save_bucketed(df: DataFrame, table_name: str, key: list[str], buckets: int, mode: str = "overwrite") -> None:
    """Bucketed/sorted table on the stay key so later joins and aggregations
    by stay read co-located data without a shuffle (S16 CTAS form)."""
    df.write.mode(mode).bucketBy(buckets, *key).sortBy(*key).saveAsTable(table_name)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


#: What a table was made of; Spark does not read files that begin with ``_``.
MANIFEST = "_manifest.json"


def _files(spark: SparkSession, path: str, times: bool) -> list[list]:
    """[name, length(, time)] of the files at ``path``, sorted; those that begin with ``_`` or ``.`` are left out."""
    fs, root = _file_system(spark, path)
    root = fs.makeQualified(root)
    found, out = fs.listFiles(root, True), []
    while found.hasNext():
        f = found.next()
        if f.getPath().getName()[:1] not in ("_", "."):
            name = f.getPath().toString()[len(root.toString()):]
            out.append([name, f.getLen(), *([f.getModificationTime()] if times else [])])
    return sorted(out)


def fingerprint(spark: SparkSession, inputs: Sequence[str], params: object = None) -> str:
    """A hash of the input paths with their files' names, lengths and times, and
    of the parameters (what JSON can state).  A missing input is an error."""
    state = {"inputs": [[p, _files(spark, p, times=True)] for p in inputs], "params": params}
    return hashlib.sha256(json.dumps(state, sort_keys=True).encode()).hexdigest()


def _read_manifest(spark: SparkSession, path: str) -> dict | None:
    fs, p = _file_system(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "ChecksumException":
            raise
        return None  # damaged
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    fs, p = _file_system(spark, f"{path.rstrip('/')}/{MANIFEST}")
    _, work = _file_system(spark, f"{path.rstrip('/')}/{MANIFEST}.work")
    stream = fs.create(work, True)
    try:
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        stream.close()
    if not fs.rename(work, p):
        raise OSError(f"cannot publish {p}")


def is_current(spark: SparkSession, path: str, wanted: str) -> bool:
    """Whether ``path`` holds a table that was written whole, from what ``wanted``
    says, and has all its files still."""
    manifest = _read_manifest(spark, path)
    return (manifest is not None and manifest.get("fingerprint") == wanted
            and manifest.get("files") == _files(spark, path, times=False))


def reuse_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame], mode: int = 1,
                     inputs: Sequence[str] = (), params: object = None) -> DataFrame:
    """S17 extraction modes: 0 = only reload, 1 = reload if current else compute
    and save, 2 = always recompute and overwrite.

    The table is current if its manifest, which is written last and published
    by a rename, states the fingerprint of ``inputs`` (paths) and ``params`` and
    the files that are there.  So a changed input or parameter, a write that was
    ended, or a lost file recomputes.  The fingerprint is taken before
    ``compute`` is asked; an input that changes meanwhile is noticed next time.
    ``compute`` must not read ``path``.  Mode 0 reads what is there unchecked."""
    if mode == 0:
        return spark.read.parquet(path)
    wanted = fingerprint(spark, inputs, params)
    if mode == 2 or not is_current(spark, path, wanted):
        compute().write.mode("overwrite").parquet(path)  # takes the former manifest away first
        _write_manifest(spark, path, {"fingerprint": wanted, "files": _files(spark, path, times=False)})
    return spark.read.parquet(path)


def variable_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Item → variable map; keep LEVEL2 set, COUNT > 0, STATUS = 'ready'."""
    vm = spark.read.option("header", True).csv(path)
    vm = vm.filter((F.coalesce(F.col("LEVEL2"), F.lit("")) != "") & (F.col("COUNT").cast("double") > 0)
                   & (F.col("STATUS") == "ready"))
    return vm.withColumn("ITEMID", F.col("ITEMID").cast("long"))


RANGE_SOURCE_COLS = ["LEVEL2", "OUTLIER LOW", "VALID LOW", "IMPUTE", "VALID HIGH", "OUTLIER HIGH"]


def variable_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Six columns renamed, first row per variable (file order), lower-case
    names, rows with any NULL dropped."""
    r = spark.read.option("header", True).csv(path).coalesce(1)
    r = r.withColumn("__row", F.monotonically_increasing_id())
    r = r.select(F.col("LEVEL2").alias("VARIABLE"),
                 *[F.col(c).cast("double").alias(c.replace(" ", "_")) for c in RANGE_SOURCE_COLS[1:]], "__row")
    w = Window.partitionBy("VARIABLE").orderBy("__row")
    r = r.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn", "__row")
    return r.withColumn("VARIABLE", F.lower("VARIABLE")).na.drop()


def column_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The column labels of a table as rows (index, name)."""
    return spark.createDataFrame(list(enumerate(df.columns)), "idx int, name string")


def exists_dir(path: str) -> bool:
    return os.path.exists(path)


def write_summary_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small report (one row per variable) as a single CSV file."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def sorted_output(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns first, the rest sorted by name, rows sorted by key
    (a range-partitioned global sort, done only at the sink)."""
    rest = sorted(c for c in df.columns if c not in keys)
    return df.select(*keys, *rest).orderBy(*keys)
