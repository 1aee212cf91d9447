"""Token files read a block at a time."""

from __future__ import annotations

import os
import sys

import numpy as np

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from playlens.llm import tokenfile  # noqa: E402
from playlens.llm.eliasfano import SAMPLE, EliasFano  # noqa: E402


def test_parts_equal_the_values():
    rng = np.random.default_rng(5)
    for n, top in ((1, 0), (1, 9), (255, 3), (SAMPLE, 10**6), (3000, 10**9), (3000, 40), (5000, 2**45)):
        values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
        coded = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
        for first, last in [(0, n), (n, n + 5), (0, 1), (n - 1, n + 9), *np.sort(rng.integers(0, n + 1, (40, 2))).tolist()]:
            assert (coded.part(first, last) == values[first:last]).all()


def test_sequential_reads_decode_a_block_at_a_time(tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    lengths = [*rng.integers(0, 9, 2000), 5000, *rng.integers(0, 9, 500)]
    writer = tokenfile.ShardWriter(str(tmp_path / "a.tok"), 2)
    texts = [rng.integers(0, 60000, n).astype(np.uint16) for n in lengths]
    ids = [None] * 700 + sorted(rng.integers(-50, 10**12, len(texts) - 700).tolist())
    for i, t in zip(ids, texts):
        writer.add(i, t)
    writer.close()
    monkeypatch.setattr(EliasFano, "values", None)  # no whole table
    monkeypatch.setattr(tokenfile, "RUN", 300)
    reader, got_ids, got = tokenfile.ShardReader(str(tmp_path / "a.tok")), [], []
    for first, ends, block in reader.blocks(target=1000):
        assert first == len(got) and len(ends) <= 300
        got_ids += reader.doc_ids(first, first + len(ends))
        got += np.split(block, ends[:-1])
    assert got_ids == ids and len(got) == len(texts)
    assert all((a == b).all() for a, b in zip(got, texts))
