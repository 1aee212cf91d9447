"""A burstable trie over word ids that counts word windows (HAT-trie).

A window is a word and the up to three that follow it in its piece. The trie
is shallow: its root leads by the first word to a hash container of the
windows' rests, and a container that grows over ``BURST`` entries bursts into
a node that leads on by the second word. A phrase's count is the sum over the
windows that begin with it, so each position is inserted once.

Subtrees leave the trie whole, as one run sorted word by word (by word ids),
from which the counts of all phrases of 1 to 4 words follow.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np

WORDS = 4
#: Bits of a word id inside a packed rest; 0 stands for "no word".
ID_BITS = 21
ID_MASK = (1 << ID_BITS) - 1
#: Entries of a container before it bursts.
BURST = 1 << 14


class HatTrie:
    """Counts of windows of packed word ids."""

    def __init__(self) -> None:
        self.children: dict[int, Counter | dict[int, Counter]] = {}
        self.size = 0

    def insert(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Add windows given by first word ids and packed rests (second word lowest)."""
        for word, part in _grouped(first, rest):
            child = self.children.get(word)
            if child is None:
                child = self.children[word] = Counter()
            if isinstance(child, Counter):
                before = len(child)
                child.update(part.tolist())
                self.size += len(child) - before
                if len(child) > BURST:
                    self.children[word] = _burst(child)
            else:
                for second, inner in _grouped(part & ID_MASK, part >> ID_BITS):
                    container = child.get(second)
                    if container is None:
                        container = child[second] = Counter()
                    before = len(container)
                    container.update(inner.tolist())
                    self.size += len(container) - before

    def take(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Remove whole subtrees, the largest first, until at most ``keep``
        entries are left; (first words, packed rests, counts) of the removed."""
        weight = {w: len(c) if isinstance(c, Counter) else sum(map(len, c.values())) for w, c in self.children.items()}
        leaving = sorted(weight, key=weight.__getitem__, reverse=True)
        first, rest, count = [], [], []
        plain_words, plain = [], []
        for word in leaving:
            if self.size <= keep:
                break
            child = self.children.pop(word)
            self.size -= weight[word]
            if isinstance(child, Counter):
                plain_words.append(word)
                plain.append(child)
            else:
                for second, container in child.items():
                    first.append(np.full(len(container), word, np.int64))
                    rest.append(np.fromiter(container, np.int64, len(container)) << ID_BITS | second)
                    count.append(np.fromiter(container.values(), np.int64, len(container)))
        total = sum(map(len, plain))
        first.append(np.repeat(np.array(plain_words, np.int64), [len(c) for c in plain]))
        rest.append(np.fromiter(chain.from_iterable(plain), np.int64, total))
        count.append(np.fromiter(chain.from_iterable(c.values() for c in plain), np.int64, total))
        return np.concatenate(first), np.concatenate(rest), np.concatenate(count)


def _grouped(keys: np.ndarray, values: np.ndarray):
    """(key, its values) for every distinct key."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    heads = keys[cuts[:-1]].tolist() if len(keys) else []
    return ((k, values[i:j]) for k, i, j in zip(heads, cuts, cuts[1:]))


def _burst(container: Counter) -> dict[int, Counter]:
    node: dict[int, Counter] = {}
    for rest, n in container.items():
        node.setdefault(rest & ID_MASK, Counter())[rest >> ID_BITS] = n
    return node


def windows(ids: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and packed rests of the window at every position; words of
    another piece are no part of it."""
    rest = np.zeros(len(ids), np.int64)
    for k in range(1, WORDS):
        same = piece[k:] == piece[:-k]
        rest[:-k] |= np.where(same, ids[k:], 0) << (ID_BITS * (k - 1))
    return ids, rest


def phrase_counts(columns: list[np.ndarray], count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows x 4 words, words in the phrase, count) of every distinct phrase
    that a window begins with, sorted word by word, shorter ones first. The
    columns hold word ids from 1, 0 for no word."""
    low = columns[2] << 32 | columns[3]
    high = columns[0] << 32 | columns[1]
    order = np.lexsort((low, high))
    table = np.stack([c[order] for c in columns], axis=1)
    count = count[order]
    rows, depth, total, place = [], [], [], []
    changed = np.zeros(len(table), bool)
    changed[:1] = True
    for k in range(WORDS):
        changed[1:] |= table[1:, k] != table[:-1, k]
        starts = np.flatnonzero(changed)
        sums = np.add.reduceat(count, starts) if len(count) else count
        real = table[starts, k] != 0
        starts, sums = starts[real], sums[real]
        found = table[starts].copy()
        found[:, k + 1 :] = 0
        rows.append(found)
        depth.append(np.full(len(starts), k + 1))
        total.append(sums)
        place.append(starts * WORDS + k)
    order = np.argsort(np.concatenate(place), kind="stable")
    return np.concatenate(rows)[order], np.concatenate(depth)[order], np.concatenate(total)[order]
