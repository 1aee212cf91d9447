"""Registered queries of the operators: each applies one operator with its
production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import alignment, ann, bpe, hamming, langid, minhash, oracles, packing, phrases, quality, repeats, sharding, simhash, tokenfile
from playlens.llm.common import table


def op1_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    found = hamming.hamming_top_k(codes, codes.where("id % 100 = 0"), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op3_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    found = ann.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"), n_shards=40)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = quality.score(docs, model)
    return out.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op6_minhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold=0.8)


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    out = langid.identify(docs, model)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write_token_files(table(spark, sf_dir, "documents"))
    return tokenfile.read_token_files(manifest)


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op11_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"), size=3, radius=3)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), min_count=30, covered=80, top=2000)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hamming_top_k": op1_hamming_top_k,
        "op2_feistel_shards": op2_feistel_shards,
        "op3_ann_search": op3_ann_search,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_minhash_duplicates": op6_minhash_duplicates,
        "op7_repeated_strings": op7_repeated_strings,
        "op8_language_id": op8_language_id,
        "op9_token_files": op9_token_files,
        "op10_bpe_codec": op10_bpe_codec,
        "op11_simhash_duplicates": op11_simhash_duplicates,
        "op12_phrase_mining": op12_phrase_mining,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
