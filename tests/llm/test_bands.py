"""Bands for every threshold."""

from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]
from llm_frames import make_docs  # noqa: E402

from playlens.llm import minhash  # noqa: E402


@pytest.mark.parametrize("threshold, rows", [(0.95, 5), (0.8, 5), (0.6, 3), (0.5, 2), (0.3, 1)])
def test_bands_follow_the_threshold(threshold, rows):
    assert minhash.band_rows(threshold) == rows
    assert (1 - threshold**rows) ** (minhash.K // rows) <= minhash.MISS
    with pytest.raises(ValueError):
        minhash.band_rows(0.01)


def test_links_at_a_low_threshold_are_found(spark):
    """Pairs of 40 words with 27 in common (27 / 53 >= 0.5): five-row bands miss one in six."""
    rows = []
    for i in range(150):
        words = [f"w{i}x{k}" for k in range(53)]
        rows += [(2 * i, " ".join(words[:40])), (2 * i + 1, " ".join(words[13:]))]
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(make_docs(spark, rows), size=1, threshold=0.5).collect()}
    assert all(found[2 * i + 1] == 2 * i for i in range(150))
