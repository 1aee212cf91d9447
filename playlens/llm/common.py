"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch, where the session doesn't say otherwise: a task holds
#: one batch in the JVM and one in Python, whatever the length of the texts.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python path once per application
    (what ``--py-files`` does), so that Arrow functions import it by name and
    the caches in their modules live as long as a worker does. Also bounds the
    session's Arrow batches by bytes, unless it has a bound of its own."""
    sc = spark.sparkContext
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    if getattr(sc, "_playlens_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="playlens-src-"), "playlens_src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(PACKAGE_ROOT, "playlens")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, PACKAGE_ROOT))
    sc.addPyFile(target)
    sc._playlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read by Spark from whatever store ``sf_dir`` is in."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """``crc32(id as decimal text) mod n``; a NULL id gives NULL."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n
