"""Session construction and cluster-shared folders."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew-join splitting handles hot join keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Small inputs: keep post-shuffle parallelism at the core count instead of
    # merging tiny partitions into one or two tasks.  Large inputs are not
    # affected (their partitions are far above this size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "stayline", extra: dict | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local/test session.  On a cluster the submitter's session is used instead.

    In local mode the driver JVM runs every task, so its heap is the only
    memory setting that matters."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in
    ``spark.checkpoint.dir``.  Only a local master (tests) may do without the
    setting and gets a scratch folder; on a cluster a missing folder is an
    error, as executors would each write to their own disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="stayline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SHIPPED: set[str] = set()  # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per
    application), so that jobs run from any folder."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="stayline-pkg-"), "stayline.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """What a submitted session needs before a query: the shared folder, the
    package on the workers, and UTC timestamps."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as parquet under the shared checkpoint folder and read
    it back: later uses scan a columnar table (pruned, filter push-down)
    instead of recomputing the lineage, and the data survives executor loss."""
    import uuid
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/stayline-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
