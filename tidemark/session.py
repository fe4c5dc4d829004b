"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every tidemark job relies on; anything the cluster already set wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them ``None`` so the submitted configuration decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only a local
    session (one machine: tests, trial runs) may leave it unset and gets a
    fresh folder under the system temp dir; on a cluster that would put
    files where other executors cannot read them, so it is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                                   f"executors share (master {sc.master})")
            current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


# Written tables and cached frames not yet released, per application.
_SCRATCH: dict[str, list[str]] = {}
_CACHED: dict[str, list[DataFrame]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder, removed by :func:`release`."""
    base = checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def cached(df: DataFrame) -> DataFrame:
    """``df`` persisted until :func:`release` (or its own ``unpersist``)."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _CACHED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(df)
    return df


def release(spark: SparkSession) -> None:
    """Remove the written tables and cached frames of all plans built so far.

    Results are lazy and read them, so call it once results are consumed.
    """
    app = spark.sparkContext.applicationId
    for df in _CACHED.pop(app, []):
        df.unpersist()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _SCRATCH.pop(app, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (pandas UDFs unpickle
    functions by module): zip the package once per SparkContext and add it
    with ``addPyFile``, which distributes it to every executor - what
    ``spark-submit --py-files`` does. The zip is a code artifact on the
    driver served by Spark's file server; no data lives there."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-py-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
