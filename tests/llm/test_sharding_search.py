"""Sharding and the two searches against brute force."""

from __future__ import annotations

import os
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

from playlens.llm import ann, hamming, queries, sharding  # noqa: E402


@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 1000, 5003])
def test_permutation_is_a_bijection_with_an_inverse(spark, n):
    df = spark.range(n).select("id", sharding.permuted("id", n, 5).alias("p"))
    df = df.withColumn("back", sharding.unpermuted("p", n, 5))
    rows = df.collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] for r in rows)


def test_large_domain_stays_in_range(spark):
    n = 10**12 + 7
    df = spark.range(0, n, n // 500).select("id", sharding.permuted("id", n, 17).alias("p"))
    df = df.withColumn("back", sharding.unpermuted("p", n, 17))
    assert df.where(f"p < 0 OR p >= {n} OR back <> id").count() == 0


def test_shards_of_odd_rows(spark):
    docs = make_docs(spark, ODD_ROWS * 9)
    rows = sharding.document_shards(docs, n_shards=7).collect()
    assert len(rows) == len(ODD_ROWS) * 9
    slots: dict[int, list] = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    expected = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in ODD_ROWS * 9)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == expected
    again = sharding.document_shards(docs.repartition(5), n_shards=7).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sharding.document_shards(docs.where("false")).count() == 0


def test_row_number_at_inverts_shard_and_slot(spark):
    rows = spark.range(100).select(F.col("id").alias("row"), F.lit("t").alias("text"))
    sharded = sharding.shard_rows(rows, ["row"], 6).withColumn("back", sharding.row_number_at("shard", "slot", 100, 6, 17))
    assert sharded.where("back <> row_number").count() == 0


def test_repeated_rows_expand_in_steps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEP", 10)
    rows = spark.range(95).select(F.lit(1).alias("a"))
    numbers = [r["row_number"] for r in sharding.number_rows(rows, ["a"]).collect()]
    assert sorted(numbers) == list(range(95))


def brute_hamming(rows, queries_, k):
    out = {}
    for q, code in queries_:
        near = sorted((bin((code ^ c) & (1 << 64) - 1).count("1"), i) for i, c in rows if i != q)[:k]
        out[q] = [(i, d) for d, i in near]
    return out


@pytest.mark.parametrize("seed, n, spread", [(0, 400, 64), (1, 400, 6), (2, 15, 64), (3, 300, 2)])
def test_hamming_top_k_is_exact(spark, seed, n, spread):
    rng = np.random.default_rng(seed)
    base = int(rng.integers(-(1 << 62), 1 << 62))
    rows = []
    for i in range(n):
        code = base
        for b in rng.integers(0, 64, rng.integers(0, spread + 1)):
            code ^= 1 << int(b) if b < 63 else -(1 << 63)
        rows.append((i, code))
    df = spark.createDataFrame(rows, "id long, code long")
    found: dict[int, list] = {}
    for r in hamming.hamming_top_k(df, df.where("id % 10 = 0"), k=7).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["id"], r["distance"]))
    assert found == brute_hamming(rows, [r for r in rows if r[0] % 10 == 0], 7)


def test_hamming_defined_results(spark):
    rows = [(1, 5), (2, 5), (2, 5), (3, None), (None, 5), (4, 7)]
    df = spark.createDataFrame(rows, "id long, code long").withColumn("seg", F.lit(1)).withColumn("ids", F.lit(2))
    got = [(r["query_id"], r["rank"], r["id"], r["distance"]) for r in hamming.hamming_top_k(df, df, k=5).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 2, 0), (1, 2, 4, 1), (2, 1, 1, 0), (2, 2, 4, 1), (4, 1, 1, 1), (4, 2, 2, 1)]
    assert hamming.hamming_top_k(df.where("false"), df.where("false")).count() == 0


def test_sign_code(spark):
    rows = [(1, [0.5, -1.0, 0.0]), (2, [1.0, None, 2.0]), (3, None), (4, [float("nan"), 1.0, 1.0]), (5, [1.0]), (6, [-1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    got = {r["id"]: r["c"] for r in df.select("id", hamming.sign_code("v", 3).alias("c")).collect()}
    assert got == {1: 1, 2: None, 3: None, 4: None, 5: None, 6: 6}


def vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)


def test_ann_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    ids, x = vectors(spark, sf)
    hits = total = 0
    found: dict[int, list] = {}
    for r in queries.op3_ann_search(spark, sf).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    assert sorted(found) == [i for i in ids if i % 20 == 0]
    for q, rows in found.items():
        score = x @ x[ids == q][0]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:20]
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(abs(r["score"] - score[ids == r["vec_id"]][0]) < 1e-12 for r in rows)
        hits += len({r["vec_id"] for r in rows} & set(ids[order].tolist()))
        total += 20
    assert hits / total >= 0.9


def test_ann_blocks_give_the_same_answers(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    whole = sorted(map(str, queries.op3_ann_search(spark, sf).collect()))
    monkeypatch.setattr(ann, "ROW_BLOCK", 200)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    ids, x = vectors(spark, sf)
    blocked = queries.op3_ann_search(spark, sf).collect()
    assert len(blocked) == len(whole)
    for r in blocked:
        assert abs(r["score"] - float(x[ids == r["query_id"]][0] @ x[ids == r["vec_id"]][0])) < 1e-12


def test_ann_defined_results(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 1.0]), (4, None), (5, [0.0, 0.0]),
        (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (1, [2.0, 0.0]), (9, [float("inf"), 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(0)).withColumn("rb", F.lit(0))
    got = [(r["query_id"], r["rank"], r["id"], r["score"]) for r in ann.nearest(df, df.where("vec_id IN (0, 4, 5)"), k=20).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, -1.0)]
    assert ann.nearest(df.where("false"), df.where("false")).count() == 0
