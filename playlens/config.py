"""Session-level helpers: shared scratch folder, stored intermediates, test sessions."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Spark removes the shuffle files of a query at its end instead of whenever
#: the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at storage every executor can reach, so
    anything written under it survives the loss of an executor. Where it is
    unset, a fresh local folder is set, but only under a local master; a
    cluster without the setting raises, since executors would each write to
    their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="playlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared folder; removed when the
    driver's Python ends, or by ``clear_scratch``."""
    path = f"{checkpoint_root(spark).rstrip('/')}/playlens-scratch/{spark.sparkContext.applicationId}"
    if not getattr(spark.sparkContext, "_playlens_scratch", False):
        spark.sparkContext._playlens_scratch = True
        atexit.register(_clear_at_exit, spark)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application stored under the shared folder.
    Frames that read stored intermediates can't be used afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _clear_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped before
        clear_scratch(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Within it, queries remove their shuffle files when they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a frame that reads it back.

    This is the lineage cut for an intermediate that several branches of a
    plan consume: one job computes it, every branch scans the written files
    (with column pruning and real size statistics for AQE), a lost executor
    costs a re-read rather than a recomputation from the raw tables, and the
    shuffle files of that job go when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffle_cleanup(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark (UTC, AQE on, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("playlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PLAYLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
