"""Session helpers: the settings every job here assumes, and the shared scratch root.

The library never builds its own session inside an operator; callers pass one in.
``build_session`` is for tests, the bench and local runs. On a cluster the
submitter's session is used as is, and only the settings below that are *unset*
get filled in by :func:`ensure_defaults`.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins at run
# time (broadcast when a side turns out small, split skewed partitions, coalesce
# small shuffle partitions); the session time zone pins timestamp semantics.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A compressed listing widens in memory by an order of magnitude: at 16 MB a scan
    # task sorts its rows for the dedup without spilling (measured).
    "spark.sql.files.maxPartitionBytes": "16m",
    # A load is some fifty jobs; the shuffle files of each go when it ends, not when the driver's
    # garbage collector comes by. A job run again from the same frame makes them again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a wide
    # listing projection crosses that and ran interpreted (3-4x slower, measured).
    # At this limit Spark falls back to split per-operator codegen for such stages.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[8]", app: str = "strata",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g")))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Fill in DEFAULTS that the session leaves unset, and a checkpoint dir when none is named."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session first. When nothing is configured, only a local session
    (one JVM: bench and tests) gets a private folder under the system temp dir; on a
    cluster each executor would write to its own disk there, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` but computes the plan once
    (an eager ``checkpoint()`` without a cache runs it twice) and stores columnar
    data. Paths are never reused.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables (``materialize`` and round trips).

    Call it when the session's results have been consumed (end of a job run, a
    bench, a test session); frames returned earlier may read from these tables.
    """
    sc = spark.sparkContext
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/scratch")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)

