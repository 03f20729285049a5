"""Spark session helpers.

Library code never creates a session of its own; it takes the caller's.
``local_session`` exists for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package is written for. AQE re-plans joins from
# runtime sizes (broadcast conversion, skew-split, partition coalescing).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quillprice") -> SparkSession:
    """A ``local[N]`` session for tests and the bench."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def submitted_session(app_name: str = "quillprice") -> SparkSession:
    """The session of a ``spark-submit`` run (master and resources from the submit).

    Without a submitted master PySpark falls back to ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a fresh scratch folder (tests); on a cluster an
    unset folder is an error, because a machine-local folder does not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="quillprice-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quillprice/{name}-{uuid.uuid4().hex}"


#: Spark then removes the shuffle files of an execution as soon as it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes within leave no shuffle files; else these stay until the driver collects its garbage.

    A write plans its frame anew, so no other execution reads the shuffles of a write.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def materialize(df, name: str, codec: str | None = None):
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Cuts the lineage: later reads see exactly the stored rows, whatever
    nondeterminism (shuffle fetch order, row ids) produced them. ``codec`` names
    parquet's compression if it is not the session's.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.parquet(path)
