"""Near duplicates and repeated strings against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

from playlens.llm import minhash, queries, repeats  # noqa: E402
from playlens.llm.components import components  # noqa: E402


# -- components -------------------------------------------------------------
@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)]
    parent: dict[int, int] = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: root(i) for i in list(parent)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- near duplicates --------------------------------------------------------
def word_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    span = min(size, len(words))
    return frozenset((span, *words[i : i + span]) for i in range(len(words) - span + 1))


def test_an_id_with_two_texts_loses_no_link(spark):
    """Both texts of id 7 keep their links; another id's copy counts as well."""
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(7, " ".join(a)), (7, " ".join(b)), (3, " ".join([*a[:-1], "x"])), (9, " ".join([*b[:-1], "y"]))]
    found = minhash.labelled(make_docs(spark, rows)).select("id", "component_id", "kept").collect()
    assert sorted(map(tuple, found)) == [(3, 3, True), (7, 3, False), (7, 7, True), (9, 7, False)]


def test_repeats_of_one_row_are_one_class(spark):
    """A third of the table is one row: its repeats collapse before any join."""
    base = " ".join(f"w{i}" for i in range(40))
    docs = make_docs(spark, [(5, base), (2, base + " end")]).select("doc_id", "text")
    many = spark.range(100_000).selectExpr("5 AS doc_id", f"'{base}' AS text")
    found = minhash.near_duplicates(docs.unionByName(many)).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(map(tuple, found)) == [(2, 2, True, 1), (5, 2, False, 100_001)]


def brute_components(docs, size, threshold):
    sets = {i: word_set(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= round(100 * threshold) * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited_copies(seed, n):
    """Groups whose members are edits of edits, around the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=4))
    docs = []
    for _ in range(n // 20):
        texts = [[word() for _ in range(rng.randint(3, 150))]]
        while len(texts) < 20:
            t = list(rng.choice(texts))
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = word()
            texts.append(t)
        docs += [" ".join(t) for t in texts]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("size, block", [(4, 512), (5, 6)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(minhash, "BLOCK", block)  # small blocks: many groups of two blocks
    docs = edited_copies(size, 300)
    found = minhash.near_duplicates(make_docs(spark, docs), size=size, threshold=0.8).collect()
    expected = brute_components(docs, size, 0.8)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_odd_rows(spark):
    found = minhash.near_duplicates(make_docs(spark, ODD_ROWS), size=4).collect()
    assert len(found) == len(ODD_ROWS)
    by_id = {(r["doc_id"], r["n_shingles"]): r for r in found}
    assert by_id[5, 4]["component_id"] == 1 and not by_id[5, 4]["kept"]
    for i in (2, 3, 4):
        assert by_id[i, 0]["component_id"] == i and by_id[i, 0]["kept"]
    assert by_id[6, 1]["kept"]
    nameless = next(r for r in found if r["doc_id"] is None)
    assert nameless["component_id"] is None and nameless["kept"]
    assert minhash.near_duplicates(make_docs(spark, ODD_ROWS).where("false")).count() == 0


def test_similarity_estimate_corrects_for_collisions():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.5, 0.8, 1.0):
        n, errors = 600, []
        for _ in range(20):
            common = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            a, b = (np.concatenate([common, rng.integers(0, 1 << 63, n - len(common), dtype=np.uint64)]) for _ in range(2))
            packed = minhash.pack(minhash.minima([a, b]))
            errors.append(minhash.similarity(packed[0], packed[1]) - len(common) / (2 * n - len(common)))
        assert abs(np.mean(errors)) < 0.03
        assert np.abs(errors).max() < 0.16


# -- repeated strings -------------------------------------------------------
def brute_repeats(docs, length):
    seen, out = set(), {}
    for d, text in sorted(docs):
        raw = (text or "").encode()
        cover = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                cover[s : s + length] = True
            seen.add(window)
        kept = np.frombuffer(raw, np.uint8)[~cover].tobytes()
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out[d] = (len(raw), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def digest(rows):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}


@pytest.mark.parametrize("length", [1, 4, 7, 100])
def test_anchors_are_the_smallest_grams(length):
    rng = random.Random(length)
    texts = [bytes(rng.choices(b"ab" if length < 50 else b"abcdefg ", k=rng.randint(0, 300))) for _ in range(40)]
    doc, pos, _ = repeats.anchors(texts, length)
    k = repeats.gram_of(length)
    expected = set()
    for i, t in enumerate(texts):
        if len(t) >= length:
            h = repeats.gram_hashes(np.frombuffer(t, np.uint8), k) >> np.uint64(repeats.LOW)
            expected |= {(i, s + int(np.argmin(h[s : s + length - k + 1]))) for s in range(len(t) - length + 1)}
    assert set(zip(doc.tolist(), pos.tolist())) == expected


def test_long_texts_are_cut_into_overlapping_segments(monkeypatch):
    rng = random.Random(8)
    text = bytes(rng.choices(b"abc", k=5000))
    whole = repeats.anchors([text, text[:70]], 20)
    monkeypatch.setattr(repeats, "SEGMENT", 320)
    cut = repeats.anchors([text, text[:70]], 20)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_column_wise_construction():
    rng = random.Random(6)
    for _ in range(150):
        m, width, length = rng.randint(1, 25), 12, 7
        rows = np.array([[rng.choice([0, 1, 2, 2, 2]) for _ in range(width)] for _ in range(m)], np.uint16)
        age = np.array(rng.sample(range(m), m))
        found = repeats.repeated_windows(rows, age, length)
        for i in range(m):
            for j in range(width - length + 1):
                w = rows[i, j : j + length]
                older = any(age[q] < age[i] and (rows[q, j : j + length] == w).all() for q in range(m))
                assert found[i, j] == bool((w != 0).all() and older)


@pytest.mark.parametrize("length, hot", [(6, 100_000), (6, 3)])
def test_remove_repeats_equals_brute_force(spark, length, hot):
    rng = random.Random(length)
    docs = [(i, "".join(rng.choices("ab", k=rng.randint(0, 40))) + "abababababab" * rng.randint(0, 2)) for i in range(120)]
    rows = repeats.remove_repeats(make_docs(spark, docs), length=length, hot=hot, with_kept=True).collect()
    assert digest(rows) == brute_repeats(docs, length)
    texts = dict(docs)
    for r in rows:
        if r["spans"]:
            kept, last = "", 0
            for a, b in r["spans"]:
                kept, last = kept + texts[r["doc_id"]][last:a], b
            assert r["kept_text"] == kept + texts[r["doc_id"]][last:]


def test_remove_repeats_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = queries.op7_repeated_strings(spark, sf).collect()
    assert digest(rows) == brute_repeats(docs, 100)


def test_remove_repeats_odd_rows(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=300))
    rows = [*ODD_ROWS, (9, long), (9, "x" + long), (None, long), (10, "é" * 200)]
    found = repeats.remove_repeats(make_docs(spark, rows), length=100, with_kept=True).collect()
    assert len(found) == len(rows)
    nines = sorted(r["n_removed"] for r in found if r["doc_id"] == 9)
    assert nines == [0, 300]
    assert sorted(r["n_removed"] for r in found if r["doc_id"] is None) == [0, 300]  # a NULL id is the last
    assert next(r for r in found if r["doc_id"] == 2)["n_bytes"] == 0
    assert repeats.remove_repeats(make_docs(spark, rows).where("false")).count() == 0
