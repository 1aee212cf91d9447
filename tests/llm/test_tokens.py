"""Token operators against the tokenizers library: exact round trips."""

from __future__ import annotations

import hashlib
import os
import random
import struct
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

from playlens.llm import bpe, packing, queries, tokenfile  # noqa: E402
from playlens.llm.eliasfano import EliasFano  # noqa: E402
from playlens.llm.fragments import split, splits_plainly  # noqa: E402
from playlens.llm.libtokens import LibraryEncoder, default_tokenizer, library_encoder  # noqa: E402

SF = "/root/testdata/sf0.001"
PIECES = ["a", "b", "é", " ", ".", ",", "\n", "'s", "1", "!", "the", " the", "ß", "  ", "\t", "×", "\xa0", "\x1c", "_", "漢", "😀", " ", "<|endoftext|>", "\x00"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        yield "".join(rng.choices(PIECES[:13] if i % 2 else PIECES, k=rng.randint(0, 12)))


def test_both_encoders_equal_the_library(library):
    fast, own = library_encoder(default_tokenizer()), bpe.forced_boundary_bpe(default_tokenizer())
    plain = 0
    for t in texts(8000, 1):
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(t.encode()), "<u4").tolist() == ids, t
        assert np.frombuffer(own.encode(t.encode()), "<u4").tolist() == ids, t
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
        if splits_plainly(t.encode(), own.special_bytes):
            plain += 1
            assert b"".join(split(t.encode())) == t.encode()
    assert plain > 1000


def test_a_slice_of_texts_equals_the_library(library):
    """Signs, contractions and rare pairs of letters, in slices with texts that don't split plainly."""
    fast = LibraryEncoder(default_tokenizer())
    rng = random.Random(7)
    pool = [" ", " ", "\n", ".", ",", "'", "'s", "'ve", "#", "##", "-", "%", "1", "22", "qx", "jvz", "fq", "s", "the", "é", "ç", "É", "!", "\t", "  ", "漢"]
    batch = ["".join(rng.choices(pool[:23] if i % 4 else pool, k=rng.randint(0, 9))).encode() for i in range(20_000)]
    assert sum(splits_plainly(t, fast.special) for t in batch) > 4000
    for limit in (fast.cache.limit, 4000, 0):  # an entry less or more must not matter
        fast.cache.limit = limit
        for k in range(0, len(batch), 2000):
            for text, ids in zip(batch[k : k + 2000], fast.encode_all(batch[k : k + 2000])):
                assert np.frombuffer(ids, "<u4").tolist() == library.encode(text.decode(), add_special_tokens=False).ids, text


def test_new_words_of_a_slice_reach_the_library_together():
    """One call of the library for the new words of a slice, none for known ones."""
    fast, calls = LibraryEncoder(default_tokenizer()), []
    inner = fast.words._ids
    fast.words._ids = lambda words: calls.append(len(words)) or inner(words)
    texts = [f"alpha{'n' * k} beta gamma".encode() for k in range(40)]
    first = fast.encode_all(texts)
    assert len(calls) == 1 and calls[0] >= 40
    assert fast.encode_all(texts) == first and len(calls) == 1
    assert fast.encode_all([]) == [] and fast.encode_all([b"", b""]) == [b"", b""]


def test_pieces_are_encoded_by_slices(spark, monkeypatch):
    """All texts of a slice reach the encoder in one call, and each gets its own ids."""

    class Slices:
        def encode_all(self, texts):
            return [struct.pack(f"<{len(t) + 1}I", *[len(texts)] * (len(t) + 1)) for t in texts]

    monkeypatch.setattr(packing, "library_encoder", lambda path: Slices())
    docs = make_docs(spark, [(i, "x" * i) for i in range(9)]).coalesce(1)
    rows = sorted(packing.token_pieces(docs, capacity=100).collect())
    assert [(r["id"], r["length"]) for r in rows] == [(i, i + 2) for i in range(9)]
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{r['length']}I", *[9] * (r["length"] - 1), 2))


def test_long_pieces_and_broken_ids(library):
    own = bpe.forced_boundary_bpe(default_tokenizer())
    t = "ab" * 3000 + "é" * 500 + "thandea" * 900 + "~" * 5000
    assert np.frombuffer(own.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    rng = random.Random(4)
    for _ in range(500):  # byte sequences that are no UTF-8
        ids = [rng.randrange(50257) for _ in range(6)]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_forced_cuts_never_lie_inside_a_token():
    own = bpe.forced_boundary_bpe(default_tokenizer())
    for token in own.id_of:
        assert all(own.inside[a][b] for a, b in zip(token, token[1:]))


def test_codec_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_bpe_codec(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_codec_odd_rows(spark, library):
    docs = make_docs(spark, ODD_ROWS)
    assert bpe.round_trip_digests(docs).count() == len(ODD_ROWS)
    coded = bpe.encode_documents(docs)
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in bpe.decode_documents(coded).collect())
    assert texts == sorted((i or 0, t or "") for i, t in ODD_ROWS)
    assert bpe.round_trip_digests(docs.where("false")).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 255, 256, 257, 3000):
        for top in (1, 5, 1000, 1 << 40):
            values = np.sort(rng.integers(0, top, n).astype(np.uint64))
            coded = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
            assert (coded.values() == values).all()
            for i in rng.integers(0, max(n, 1), min(n, 60)):
                assert coded.select(int(i)) == int(values[i])
            if n > 2000 and top > 1000:
                bits = 8 * len(coded.to_bytes())
                assert bits < 64 * n * 0.85
    with pytest.raises(ValueError):
        EliasFano.of(np.array([2, 1]))


def test_token_files_equal_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in queries.op9_token_files(spark, SF).collect()}
    at = 0
    for doc_id in sorted(docs):
        ids = library.encode(docs[doc_id], add_special_tokens=False).ids + [2]
        r = rows[doc_id]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_token_files_odd_rows_and_point_reads(spark, library):
    docs = make_docs(spark, ODD_ROWS)
    manifest = tokenfile.write_token_files(docs.repartition(3))
    rows = sorted(tokenfile.read_token_files(manifest).collect(), key=lambda r: r["start"])
    assert len(rows) == len(ODD_ROWS) and rows[0]["doc_id"] is None
    known = [r["doc_id"] for r in rows[1:]]
    assert known == sorted(known)
    assert [r["start"] for r in rows[1:]] == list(np.cumsum([r["n_tokens"] for r in rows])[:-1])
    first = tokenfile.read_document(spark, manifest, rows[0]["shard"], 0)
    assert first.tolist() == library.encode("a row without an id", add_special_tokens=False).ids + [2]
    empty = tokenfile.write_token_files(docs.where("false"))
    assert tokenfile.read_token_files(empty).count() == 0


def test_packing_plan_places_every_piece_once():
    rng = random.Random(3)
    shapes = [lambda: rng.randint(1, 1024), lambda: rng.randint(340, 700), lambda: rng.choice([1, 5, 341, 342, 512, 513, 1023, 1024]), lambda: 1]
    for shape in shapes:
        for n in (1, 7, 500, 20000):
            counts: dict[int, int] = {}
            for _ in range(n):
                k = shape()
                counts[k] = counts.get(k, 0) + 1
            bins = packing.plan_bins(counts, 1024)
            seen: dict[int, list] = {}
            for b in bins:
                assert b.used() <= 1024 and b.count > 0
                for length, rank in b.items:
                    seen.setdefault(length, []).append((rank, b.count))
            for length, n_pieces in counts.items():
                at = 0
                for rank, many in sorted(seen[length]):
                    assert rank == at
                    at += many
                assert at == n_pieces
            used, bound = sum(b.count for b in bins), -(-sum(k * c for k, c in counts.items()) // 1024)
            assert used >= bound
            if shape is shapes[0] and n == 20000:
                assert used <= 1.01 * bound


def _best_fit_decreasing(lengths, capacity):
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("low,high,n", [(1, 64, 300), (10, 27, 400), (13, 44, 300), (17, 22, 100), (1, 9, 200), (30, 40, 50)])
def test_packing_plan_against_best_fit_decreasing(low, high, n):
    rng = random.Random(low * high)
    for _ in range(3):
        lengths = [rng.randint(low, high) for _ in range(n)]
        used = sum(b.count for b in packing.plan_bins(Counter(lengths), 64))
        assert -(-sum(lengths) // 64) <= used <= _best_fit_decreasing(lengths, 64)


def test_packing_plan_uses_configurations_of_many_pieces():
    rng = random.Random(1)
    counts = Counter(rng.randint(150, 419) for _ in range(200_000))
    assert sum(b.count for b in packing.plan_bins(counts, 1024)) < 56_400


def _fewest_bins(lengths, capacity):
    """Exact: depth-first over the open rooms, longest first."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def go(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= lengths[at]:
                i = rooms.index(room)
                go(at + 1, [*rooms[:i], room - lengths[at], *rooms[i + 1 :]])
        go(at + 1, [*rooms, capacity - lengths[at]])

    go(0, [])
    return best


def test_packing_plan_near_the_exact_optimum():
    rng = random.Random(5)
    for _ in range(20):
        lengths = [rng.randint(8, 40) for _ in range(9)]
        used = sum(b.count for b in packing.plan_bins(Counter(lengths), 64))
        best = _fewest_bins(lengths, 64)
        assert best <= used <= best + 1


def test_general_knapsack_layers():
    counts = {100: 40, 150: 30, 210: 20, 333: 10}
    bins = packing.plan_scheme(counts, 1024, groups=100, small_share=12)
    assert sum(b.count * len(b.items) for b in bins) == 100
    assert sum(b.count for b in bins) <= 1 + -(-sum(k * c for k, c in counts.items()) // 1024)


@pytest.mark.parametrize("n, expected", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]), (2048, [(0, 1024), (1024, 1024)]), (2500, [(0, 452), (452, 1024), (1476, 1024)])])
def test_piece_bounds(n, expected):
    assert packing.piece_bounds(n, 1024) == expected


def check_sequences(rows, capacity):
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_query(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op5_best_fit_packing(spark, SF).collect()
    n = check_sequences(rows, 1024)
    assert n <= 1.05 * sum(r["length"] for r in rows) / 1024 + 1
    by_doc: dict[int, list] = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in docs.items():
        ids, at = library.encode(text, add_special_tokens=False).ids + [2], 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            own = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(own))
            assert k == 0 or r["length"] == 1024
            at += r["length"]
        assert at == len(ids)


def test_packing_odd_rows(spark):
    docs = make_docs(spark, ODD_ROWS)
    rows = packing.pack_documents(docs, capacity=64, with_ids=True).collect()
    check_sequences(rows, 64)
    assert sum(1 for r in rows if r["piece"] == 0) == len(ODD_ROWS)
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert packing.pack_documents(docs.where("false")).count() == 0
