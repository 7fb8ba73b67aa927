"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Partition counts are left to AQE, which sizes
# shuffle partitions from the bytes actually written.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python kernels are capped by bytes as well as rows: a 2048 x 2048
    # float32 block is 16 MB, so a 10,000-row batch of blocks would not fit in memory.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tessera", **conf) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def machine_local_is_shared(master: str) -> bool:
    """Do the driver and all executors run on this machine, so that a local folder serves both?"""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session.  Only when it is unset (local runs and tests) a
    folder of our own is created once per application and registered with the
    SparkContext (the conf itself cannot be changed at runtime).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not machine_local_is_shared(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app)
        if root is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
            root = spark.sparkContext.getCheckpointDir()     # later calls read it back the same
            _LOCAL_ROOTS[app] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one job's intermediate output."""
    return f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    return uri[len("file:"):] if uri.startswith("file:") else uri


def path_exists(spark: SparkSession, uri: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(uri)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


__all__ = ["DEFAULT_CONF", "get_session", "checkpoint_root", "scratch_path", "path_exists"]
