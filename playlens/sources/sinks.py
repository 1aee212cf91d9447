"""Sinks (S3, S4) and row previews.

Result tables are written by the executors, partition by partition, into a
folder on shared storage; only a bounded top-k result is coalesced to one
file. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlens.sources.plays import read_exact_tsv, write_exact_tsv


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """S3: tab-separated text with a header line, no index column.

    Texts are escaped (``plays.escaped``): one line per row and one field per
    column whatever they hold. ``single_file=True`` is for bounded results (a
    top-k table); large tables are written in parallel, one file per partition.
    """
    write_exact_tsv(df.coalesce(1) if single_file else df, path, header=True)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back a TSV written by ``write_tsv`` with an explicit schema."""
    return read_exact_tsv(spark, path, StructType.fromDDL(schema), header=True)


def write_rejected(scanned: DataFrame, path: str) -> None:
    """The rejected lines of ``plays.scan_lines`` with their reasons, written in
    parallel as Parquet, so that they can be mended and read again."""
    scanned.where("reason IS NOT NULL").select("reason", "line").write.mode("overwrite").parquet(path)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("reason string, line string").parquet(path)


def write_coefficients(coefs: DataFrame, path: str) -> None:
    """The fitted model table ``(keys, model, params, slope, intercept)`` as
    Parquet - the distributed replacement for pickling one estimator."""
    coefs.write.mode("overwrite").parquet(path)


def read_coefficients(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def preview(df: DataFrame, order_cols: list[str], n: int = 10, tail: bool = False) -> DataFrame:
    """The first (or last) ``n`` rows in a total order (TakeOrderedAndProject).
    ``tail`` reverses the order; the rows come back in that reversed order."""
    cols = [F.col(c).desc_nulls_last() if tail else F.col(c).asc_nulls_first() for c in order_cols]
    return df.orderBy(*cols).limit(int(n))
