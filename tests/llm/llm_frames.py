"""Frames and helpers of the operator tests."""

from __future__ import annotations

from pyspark.sql import functions as F

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns they must not matter.
CLASHING = ["id", "d", "part", "n", "size", "shard", "slot", "length", "piece", "start", "score", "node", "gram", "key", "_n", "_r", "code", "places"]


def make_docs(spark, rows, extra=True):
    """rows: (doc_id, text[, lang]); with extra columns of clashing names."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None) for r in rows]
    df = spark.createDataFrame(rows, DOC_DDL)
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)]) if extra else df


ODD_ROWS = [
    (1, "Plain words, and more words.\nAnother line."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "Plain words, and more words.\nAnother line."),
    (6, "ab" * 30000),
    (7, "naïve café — 漢字 😀 x"),
    (7, "the same id, another text"),
    (None, "a row without an id"),
    (8, "repeated row"),
    (8, "repeated row"),
    (-3, "12345 !!! <|endoftext|> tail  two  spaces "),
]
