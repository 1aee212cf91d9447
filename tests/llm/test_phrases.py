"""Phrase mining against a plain count of every phrase."""

from __future__ import annotations

import os
import random
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

from playlens.llm import hattrie, phrases  # noqa: E402


def brute(rows, min_count, covered=80, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            hidden = any(
                len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not hidden:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(seed, n, long_piece=0):
    rng = random.Random(seed)
    vocab = ["the", "Of", "x", "naïve", "漢字", "a-b", "0", "it's"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "! ", "\x0c"]) for _ in range(rng.randint(0, 60)))
        rows.append((text + (" new york city hall" if i % 3 else " New York"), rng.choice(["en", "fr", None])))
    if long_piece:
        rows.append((" ".join(rng.choices(vocab, k=long_piece)), "en"))
    return rows


@pytest.mark.parametrize("entries,chunk,burst", [(600_000, 1 << 17, 1 << 14), (50, 40, 8)])
def test_small_tries_give_the_same_phrases(spark, monkeypatch, entries, chunk, burst):
    """In one piece, and with subtrees that burst and leave all the time."""
    rows = random_rows(3, 300, long_piece=500)
    state = phrases.TaskCounts(7, entries)
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(hattrie, "BURST", burst)
    monkeypatch.setattr(phrases, "VOCABULARY", 60 if entries == 50 else 1 << 19)
    runs = []
    for text, lang in rows:
        runs += state.add(lang or "und", [text.encode()])
    runs += state.spill(everything=True)
    want = {}
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    key = (lang or "und", " ".join(words[i : i + n]))
                    want[key] = want.get(key, 0) + 1
    grouped = {}
    for lang, bucket, run in runs:
        grouped.setdefault((lang, bucket), []).append(run)
    got = {}
    for (lang, _), parts in grouped.items():
        words, counts, _ = phrases.merged(parts, 1)
        for p, c in zip(words, counts.tolist()):
            assert (lang, p.decode()) not in got
            got[lang, p.decode()] = c
    assert got == want
    assert entries > 50 or len(runs) > 1000


def test_collocations_equal_brute_force(spark):
    rows = random_rows(5, 400)
    docs = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)])
    assert found(phrases.collocations(docs, min_count=5, entries=500)) == brute(rows, 5)
    assert found(phrases.collocations(docs, min_count=3, covered=50, top=7)) == brute(rows, 3, 50, 7)


def test_rare_words_end_windows_and_count_in_n(spark):
    rng = random.Random(8)
    rows = [(" ".join(w if rng.random() < 0.7 else f"junk{rng.randint(0, 400)}" for w in rng.choices("abcd", k=60)), rng.choice(["en", "de"])) for _ in range(80)]
    docs = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)])
    assert found(phrases.collocations(docs, min_count=12)) == brute(rows, 12)
    texts = docs.selectExpr("lang", "text")
    bits = phrases.frequent_words(texts, 12)
    assert len(bits) * 8 == phrases.MAP_BITS
    known = phrases.WordIds("en", [b""], bits)
    assert all(known[w] > 0 for w in (b"a", b"b", b"c", b"d"))
    assert sum(known[b"never%d" % i] > 0 for i in range(1000)) < 5


def test_odd_rows_and_empty_table(spark):
    rows = [(r[1], "en") for r in ODD_ROWS] * 3
    docs = make_docs(spark, [(i, t) for i, (t, _) in enumerate(rows)])
    assert found(phrases.collocations(docs, min_count=2)) == brute(rows, 2)
    assert phrases.collocations(make_docs(spark, [])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000
    rows = [("en", "", 2 * big), ("en", "a", big + 1), ("en", "b", big + 3), ("en", "a b", big)]
    counted = spark.createDataFrame(rows, "lang string, phrase string, f long")
    got = phrases.scored(counted, covered=80, top=10).first()
    assert got["score"] == 2000000 * big // (2 * big + 4) and (got["l"], got["r"], got["n"]) == (big + 1, big + 3, 2 * big)


@pytest.mark.parametrize("chunk,leave", [(1 << 19, 1 << 21), (40, 30)])
def test_pair_runs_hold_every_neighbour(monkeypatch, chunk, leave):
    """Sums of runs equal plain counts, also across parts of a long piece."""
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "PAIRS_HELD", leave)
    monkeypatch.setattr(phrases, "PAIRS_LEAVE", leave)
    monkeypatch.setattr(phrases, "VOCABULARY", 1 << 19 if leave > 30 else 20)
    rows = random_rows(11, 60, long_piece=900)
    state = phrases.PairCounts(5, b"\xff" * (phrases.MAP_BITS // 8))
    runs = [run for text, lang in rows for run in state.add(lang or "und", [text.encode()])] + list(state.leave())
    got, want = Counter(), Counter()
    for bucket, run in runs:
        slots, counts = phrases.decode_pairs(run)
        assert (slots % 5 == bucket).all() and (slots[1:] > slots[:-1]).all()
        got.update(dict(zip(slots.tolist(), counts.tolist())))
    for text, lang in rows:
        seed = phrases.word_seed(lang or "und")
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m.group().lower(), text)):
            codes = phrases.np.array([phrases.word_hash(w.encode(), seed) for w in re.findall("[^\x20\x09]+", piece)], phrases.np.uint64)
            want.update(phrases.pair_slots(codes[:-1], codes[1:]).tolist() if len(codes) else [])
    assert got == want


def test_counts_over_a_byte_survive_a_pair_run():
    slots, counts = phrases.np.array([0, 5, (1 << 40) - 1]), phrases.np.array([1, 255, 1 << 40])
    got = phrases.decode_pairs(phrases.encode_pairs(slots, counts))
    assert got[0].tolist() == slots.tolist() and got[1].tolist() == counts.tolist()
    none = phrases.decode_pairs(phrases.encode_pairs(slots[:0], counts[:0]))
    assert len(none[0]) == len(none[1]) == 0


def test_rare_pairs_end_windows(spark):
    """Frequent words whose neighbours are mostly rare: fewer windows, same phrases."""
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(120)]
    rows = [(" ".join(rng.choices(vocab, k=80) + ["open", "source", "code"]), rng.choice(["en", "de"])) for _ in range(100)]
    docs = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)])
    assert found(phrases.collocations(docs, min_count=9)) == brute(rows, 9)
    words = phrases.frequent_words(docs.selectExpr("lang", "text"), 9)
    pairs = phrases.frequent_pairs(docs.selectExpr("lang", "text"), 9, spark.sparkContext.broadcast(words), 4)
    assert len(pairs) * 8 == phrases.PAIR_BITS
    state = phrases.TaskCounts(4, frequent=words, pairs=pairs)
    everything = phrases.TaskCounts(4, frequent=words)
    size = [sum(len(r) for _, _, r in [*s.add("en", [t.encode() for t, x in rows if x == "en"]), *s.spill(True)]) for s in (state, everything)]
    assert size[0] < size[1] / 2
