"""Typed, long-form column summaries (the ``describe()`` statistics)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Number of decimals that ``rounded`` keeps, so that two engines that sum in a
# different order report the same value. Operators return full precision;
# rounding is for comparison and display only.
DOUBLE_DECIMALS = 6

# Scores are ranked by this many significant digits, whatever their scale:
# two sums of the same numbers in another order tie.
RANK_DIGITS = 10


def rounded(c: Column, decimals: int = DOUBLE_DECIMALS) -> Column:
    """Round to ``decimals`` and fold -0.0 into 0.0 (``+ 0.0``), so that a
    tiny negative value reads the same in every engine."""
    return F.round(c.cast("double"), decimals) + F.lit(0.0)


def significant(c: Column, digits: int = RANK_DIGITS) -> Column:
    """``c`` cut to ``digits`` significant digits; scaling by a power of ten
    never changes the order of two values."""
    return F.format_string(f"%.{digits - 1}e", c.cast("double")).try_cast("double")


def present(df: DataFrame) -> DataFrame:
    """Every DOUBLE column rounded for comparison between engines."""
    return df.select(*[rounded(F.col(f"`{n}`")).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes])


def numeric_summary(df: DataFrame, column: str, value: Column | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max of one numeric column, one row.

    ``value`` may be an expression over ``df`` (e.g. a unit conversion);
    ``column`` then names it. min/max keep the input type.
    """
    v = F.col(column) if value is None else value
    return df.agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("stddev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


def string_summary(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """``describe()`` of string columns in long form, one pass over ``df``.

    Output ``(column, count, mean, stddev, min, max)``: count of non-NULL
    values, mean and sample stddev of the values that read as numbers,
    lexicographic min and max. All columns are aggregated in a single
    ``agg`` and then unpivoted, so the table is scanned once.
    """
    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    aggs = []
    for i, c in enumerate(columns):
        num = f"try_cast({q(c)} AS DOUBLE)"
        aggs += [
            f"count({q(c)}) AS c{i}_count",
            f"avg({num}) AS c{i}_mean",
            f"stddev_samp({num}) AS c{i}_stddev",
            f"min({q(c)}) AS c{i}_min",
            f"max({q(c)}) AS c{i}_max",
        ]
    wide = df.agg(*[F.expr(a) for a in aggs])
    rows = "array(" + ", ".join(
        f"named_struct('column', '{c.replace(chr(39), chr(92) + chr(39))}', 'count', c{i}_count, 'mean', c{i}_mean, "
        f"'stddev', c{i}_stddev, 'min', c{i}_min, 'max', c{i}_max)"
        for i, c in enumerate(columns)
    ) + ")"
    return wide.selectExpr(f"inline({rows})")
