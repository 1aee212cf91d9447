"""SimHash fingerprints and covering links against brute force."""

from __future__ import annotations

import os
import random
import re
import sys

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

from playlens.llm import queries, simhash  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def brute_fingerprint(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    span = min(size, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + span]).encode(), seed=42).intdigest() for i in range(len(words) - span + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(found, radius=3):
    """(fingerprint -> smallest id) over links of all pairs."""
    nodes = sorted(set(found))
    parent = {n: n for n in nodes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def check(docs, rows):
    prints = [brute_fingerprint(r[1]) for r in rows]
    classes = brute_classes([p for p, r in zip(prints, rows) if r[0] is not None])
    least = {}
    for p, r in zip(prints, rows):
        if r[0] is not None:
            least[classes[p]] = min(r[0], least.get(classes[p], r[0]))
    want = sorted(((r[0], f"{p:016x}", None if r[0] is None else least[classes[p]]) for p, r in zip(prints, rows)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in docs.collect()), key=repr) == want


def test_odd_rows(spark):
    check(simhash.simhash_duplicates(make_docs(spark, ODD_ROWS)), ODD_ROWS)


def test_empty_table(spark):
    assert simhash.simhash_duplicates(make_docs(spark, [])).count() == 0


def test_repeated_ids_are_labelled_by_their_own_text(spark):
    base = [f"w{i}" for i in range(200)]
    near = [*base[:-1], "other"]
    far = [f"v{i}" for i in range(200)]
    rows = [(7, " ".join(base)), (7, " ".join(far)), (3, " ".join(near)), (9, " ".join([*far[:-1], "x"]))] + [(5, "same")] * 500
    check(simhash.simhash_duplicates(make_docs(spark, rows)), rows)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    check(queries.op11_simhash_duplicates(spark, SF001), rows)


def test_long_texts_go_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices(["a", "bb", "ccc", "Dd"], k=1000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text.encode()) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_within_the_radius_collides(radius):
    rng = random.Random(radius)
    for level, parent in enumerate([0, simhash.mask_levels(radius, 1)[0][2][1]]):
        masks = simhash.covering_masks(parent, radius)
        assert len(masks) == (1 << (radius + 1)) - 1
        free = [i for i in range(64) if not parent >> i & 1]
        for _ in range(3000):
            differing = sum(1 << i for i in rng.sample(free, rng.randint(1, radius)))
            assert any(differing & m == 0 for m in masks), (level, differing)


@pytest.mark.parametrize("limit", [1, 4, 1024])
def test_dense_buckets_keep_all_links(spark, limit):
    """Fingerprints crowded around two centres, so that buckets are covered again."""
    rng = random.Random(limit)
    prints = set()
    for centre in (rng.getrandbits(64), rng.getrandbits(64)):
        for _ in range(300):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    parent = {p: p for p in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in simhash.links(nodes, 3, limit).collect():
        a, b = int(np.int64(r["a"]).view(np.uint64)), int(np.int64(r["b"]).view(np.uint64))
        assert (a ^ b).bit_count() <= 3
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = brute_classes(prints)
    assert {p: root(p) for p in prints} == want
