"""The corpus pipeline: language ID, quality, near duplicates, repeated
strings and packing over the ``documents`` table.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``. Rows without an id pass the stages that decide by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm import langid, minhash, packing, quality, repeats
from playlens.llm.common import ship, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are far from every language go; a missing language is
    filled in with the predicted one."""
    ship(spark)
    model = langid.fit(docs.where(~langid.held_out()))
    found = docs.select(*COLUMNS, langid.predictor(model)(F.col("text")).alias("_p")).where(~F.col("_p.rejected"))
    return found.select("doc_id", "text", F.coalesce("lang", "_p.lang_pred").alias("lang"), "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold go."""
    ship(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(*COLUMNS, quality.scorer(spark, model)(F.col("text")).alias("_s"))
    return scored.where(F.col("_s") >= quality.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest id."""
    docs = docs.select(*COLUMNS)
    found = minhash.labelled(docs, size=5, threshold=0.8).where("kept AND id IS NOT NULL")
    # A group's smallest id may hold several of its texts: the one with the
    # smallest hash stays. Texts without shingles are in no group.
    one = found.where("n > 0").groupBy("component").agg(F.min(F.struct("id", "h")).alias("_k")).select("_k.id", "_k.h")
    none = found.where("n = 0").select("id", "h").distinct()
    kept = materialize(one.unionByName(none).select(F.col("id").alias("_id"), F.col("h").alias("_h")), "kept")
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    staying = hashed.join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_semi")
    if not staying.groupBy("doc_id", "_hash").count().where("count > 1").isEmpty():
        staying = staying.dropDuplicates(["doc_id", "_hash"])
    return staying.drop("_hash").unionByName(docs.where("doc_id IS NULL"))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 100 that start earlier leave the texts."""
    docs = docs.select(*COLUMNS)
    cut = repeats.remove_repeats(docs, length=100, with_kept=True).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "kept_text").dropDuplicates(["_id", "_hash"])
    joined = docs.join(cut, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    text = F.coalesce("kept_text", "text")
    changed = F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return joined.select("doc_id", text.alias("text"), "lang", "source", changed.alias("n_chars"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs, capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", best_fit_packing),
]

#: Trained models and tokenizer ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read
    again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
