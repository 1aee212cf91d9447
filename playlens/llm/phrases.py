"""Phrase collocations: which word sequences of a language belong together.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and 0x0A-0x0D
and into words at space and tab. Per language (NULL: ``und``) n counts all
words and f(phrase) all contiguous occurrences inside pieces.

1. **Pruning.** A phrase is at most as frequent as its rarest word, so a word
   under ``min_count`` ends windows as a separator does. Words are counted by
   64-bit hash (pre-aggregated in every task, summed by Spark) and the frequent
   hashes set bits of one map of ``MAP_BITS`` bits, which every task gets. Pairs
   of the remaining neighbours are counted the same way, by ``SLOT_BITS`` bits of
   their hash in sorted runs, and windows end between the words of a rare pair
   (a map of ``PAIR_BITS`` bits). A shared bit or hash only keeps a rare word or
   pair in, so results are exact at any load.
2. **Counting.** Every task counts the windows of its texts in HAT-tries, one a
   language (``hattrie``). When they hold over ``ENTRIES`` windows, whole
   subtrees leave as one run in word-id order; phrases are dealt to prefix partitions by
   a hash of their first three words, so neither a common word nor a common
   pair lands in one task. Inside a partition a run is front coded: a phrase
   writes only the words it does not share with the one before.
3. **Merging.** A task reads the runs of a prefix partition one partition at a
   time and merges them; only phrases of ``min_count`` occurrences go on.
4. **Scoring** is DataFrame work over the frequent phrases: both parts of a
   frequent phrase are frequent themselves, so joins of that table with itself
   give l and r; all arithmetic is exact (decimals).

The number of prefix partitions is ``SPREAD`` times ``spark.sql.shuffle.partitions``,
so a partition's size follows the shuffle's.

Defined results: a NULL or empty text has no words; a language without a
candidate has no rows; words may be of any length; repeated rows count each;
ids are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest as word_hash

from playlens.config import materialize
from playlens.llm.batches import text_slices
from playlens.llm.common import ship
from playlens.llm.hattrie import ID_BITS, ID_MASK, WORDS, HatTrie, phrase_counts, windows
from playlens.llm.workercache import hold

UNDETERMINED = "und"
#: Windows that the tries of a task hold, and distinct words, before subtrees leave.
ENTRIES, VOCABULARY = 1_000_000, 1 << 19
#: Words of a language inserted at a time.
CHUNK = 1 << 19
#: Prefix partitions to a shuffle partition.
SPREAD = 2
#: Bits of the map of frequent words (4 MB).
MAP_BITS = 1 << 25
#: Bits of a pair's hash that are counted, and of the map of frequent pairs (16 MB).
SLOT_BITS, PAIR_BITS = 40, 1 << 27
#: Pairs that a task holds before they are summed, and distinct ones before they leave.
PAIRS_HELD, PAIRS_LEAVE = 1 << 22, 1 << 21
#: Prefix partition of the numbers of pruned words.
PRUNED = -1
#: Piece separators become line feeds.
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


# -- counting ---------------------------------------------------------------
class WordIds(dict):
    """The words of a language -> id, the place in ``words`` (shared by all
    languages of a task) in order of appearance, or 0 for a rare word. The
    word's hash goes to the same place of ``codes``."""

    def __init__(self, lang: str, words: list[bytes], frequent: bytes, codes: array | None = None):
        self.seed, self.words, self.frequent = word_seed(lang), words, frequent
        self.codes = array("Q", [0]) if codes is None else codes

    def __missing__(self, word: bytes) -> int:
        code = word_hash(word, self.seed)
        at = code & MAP_BITS - 1
        found = 0
        if self.frequent[at >> 3] >> (at & 7) & 1:
            found = len(self.words)
            self.words.append(word)
            self.codes.append(code)
        self[word] = found
        return found


def word_seed(lang: str) -> int:
    return zlib.crc32(lang.encode())


def word_counts(lang_texts: Iterator[tuple[str, list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word hashes, counts), pre-aggregated over some ``VOCABULARY`` words."""
    held: dict[str, Counter] = {}

    def leave() -> tuple[np.ndarray, np.ndarray]:
        n = sum(map(len, held.values()))
        found = chain.from_iterable(map(word_hash, c, repeat(word_seed(lang))) for lang, c in held.items())
        counts = chain.from_iterable(c.values() for c in held.values())
        return np.fromiter(found, np.uint64, n).view(np.int64), np.fromiter(counts, np.int64, n)

    for lang, texts in lang_texts:
        counter = held.setdefault(lang, Counter())
        for text in texts:
            counter.update(text.lower().translate(_PIECES).split())
        if sum(map(len, held.values())) > VOCABULARY:
            yield leave()
            held.clear()
    yield leave()


def frequent_words(texts: DataFrame, min_count: int) -> bytes:
    """The map of words that may have ``min_count`` occurrences in their
    language, from texts (lang, text). Its bits come to the driver: ``MAP_BITS``
    whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, n in word_counts(_lang_texts(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["h", "n"])

    words = texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return _bit_map(words, MAP_BITS)


def _bit_map(hashes: DataFrame, size: int) -> bytes:
    """The bits set by the hashes of a column ``h``."""
    at = F.col("h").bitwiseAND(F.lit(size - 1).cast("long"))
    slots = hashes.select(F.shiftright(at, 6).cast("int").alias("slot"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    rows = slots.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, "<i8")
    bits[rows["slot"].to_numpy()] = rows["bits"].to_numpy()
    return bits.tobytes()


def pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of a pair of words, from theirs."""
    key = first * np.uint64(0x9E3779B97F4A7C15) ^ (second << np.uint64(31) | second >> np.uint64(33))
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(32)
    return key * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - SLOT_BITS)


class PairCounts:
    """The pairs of one task, summed by hash, and the sorted runs that leave."""

    def __init__(self, buckets: int, frequent: bytes):
        self.buckets, self.frequent = buckets, frequent
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.slots, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._renew()

    def _renew(self) -> None:
        self.words, self.codes, self.ids = [b""], array("Q", [0]), {}

    def add(self, lang: str, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """Count the pairs of some texts; yields the runs that leave meanwhile."""
        for words, pieces in _piece_words(texts):
            known = self.ids.get(lang)
            if known is None:
                known = self.ids[lang] = WordIds(lang, self.words, self.frequent, self.codes)
            ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            pair = (pieces[1:] == pieces[:-1]) & (ids[1:] > 0) & (ids[:-1] > 0)
            codes = np.array(self.codes, np.uint64)[ids]
            self.waiting.append(pair_slots(codes[:-1][pair], codes[1:][pair]).view(np.int64))
            self.n_waiting += len(self.waiting[-1])
            if self.n_waiting > PAIRS_HELD:
                self._sum()
            if len(self.slots) > PAIRS_LEAVE:
                yield from self.leave()
            if sum(map(len, self.ids.values())) > VOCABULARY:
                self._renew()

    def _sum(self) -> None:
        slots = np.concatenate([self.slots, *self.waiting])
        counts = np.concatenate([self.counts, np.ones(self.n_waiting, np.int64)])
        self.slots, self.counts = summed(slots, counts)
        self.waiting, self.n_waiting = [], 0

    def leave(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, run) of everything held."""
        self._sum()
        bucket = self.slots % self.buckets
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for k in range(self.buckets):
            part = order[cuts[k] : cuts[k + 1]]
            if len(part):
                yield k, encode_pairs(self.slots[part], self.counts[part])
        self.slots, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)


def summed(slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots in ascending order with the sums of their counts."""
    order = np.argsort(slots)
    slots = slots[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(slots)), bool), slots[1:] != slots[:-1]]))
    return slots[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def encode_pairs(slots: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending slots as differences, byte by byte, and counts; compressed."""
    import zstandard

    steps = np.diff(slots, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8)
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<i8")
    head = np.array([len(slots)], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in (head, steps.T, small, large)))


def decode_pairs(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(run)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n).T).view("<i8").ravel()
    counts = np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", offset=8 + 9 * n)
    return np.cumsum(steps), counts


def frequent_pairs(texts: DataFrame, min_count: int, frequent, buckets: int) -> bytes:
    """The map of neighbours that may have ``min_count`` occurrences in their
    language, from texts (lang, text) and the broadcast map of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("phrases")
        state = PairCounts(buckets, frequent.value)
        kinds = {"bucket": pa.int64(), "run": pa.binary()}
        for lang, texts in _lang_texts(batches):
            yield from _run_batches(state.add(lang, texts), kinds)
        yield from _run_batches(state.leave(), kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, runs in _run_groups(batches):
            slots, counts = summed(*(np.concatenate(c) for c in zip(*map(decode_pairs, runs))))
            yield pa.RecordBatch.from_arrays([pa.array(slots[counts >= min_count])], ["h"])

    runs = texts.mapInArrow(count, "bucket long, run binary")
    pairs = runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "h long")
    return _bit_map(pairs, PAIR_BITS)


def _piece_words(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words with the numbers of their pieces, some ``CHUNK`` at a time. A part
    that a long piece goes on after opens with the last word before it."""
    held: list[bytes] = []
    lengths: list[int] = []
    for text in texts:
        for piece in text.lower().translate(_PIECES).split(b"\n"):
            words = piece.split()
            while len(words) > CHUNK:
                yield words[:CHUNK], np.zeros(CHUNK, np.int64)
                words = words[CHUNK - 1 :]
            if words:
                held += words
                lengths.append(len(words))
            if len(held) > CHUNK:
                yield held, np.repeat(np.arange(len(lengths)), lengths)
                held, lengths = [], []
    if held:
        yield held, np.repeat(np.arange(len(lengths)), lengths)


def _lang_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a slice of rows, by language."""
    for part, texts in text_slices(batches, 1):
        langs = part.column(0).to_pylist()
        for lang in dict.fromkeys(langs):
            yield lang, [t for t, x in zip(texts, langs) if x == lang]


class TaskCounts:
    """The tries of one task and what leaves them. Windows wait until ``CHUNK``
    of a language can be dealt to its trie at once."""

    def __init__(
        self, buckets: int, entries: int = ENTRIES, frequent: bytes = b"\xff" * (MAP_BITS // 8), pairs: bytes | None = None
    ):
        self.buckets, self.entries, self.frequent = buckets, entries, frequent
        self.pairs = None if pairs is None else np.frombuffer(pairs, np.uint8)
        self._renew()

    def _renew(self) -> None:
        self.words, self.codes = [b""], array("Q", [0])
        self.ids: dict[str, WordIds] = {}
        self.pruned: dict[str, int] = {}
        self.hashes = np.zeros(1, np.uint64)
        self.tries: dict[str, HatTrie] = {}
        self.waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.n_waiting: dict[str, int] = {}

    def add(self, lang: str, texts: list[bytes]) -> Iterator[tuple[str, int, bytes]]:
        """Count the windows of some texts; yields what leaves meanwhile."""
        held: list[bytes] = []
        lengths: list[int] = []
        for text in texts:
            for piece in text.lower().translate(_PIECES).split(b"\n"):
                words = piece.split()
                while len(words) > CHUNK:  # a long piece goes in parts that know the words after them
                    yield from self._wait(lang, words[: CHUNK + WORDS - 1], None, CHUNK)
                    words = words[CHUNK:]
                if words:
                    held += words
                    lengths.append(len(words))
                if len(held) > CHUNK:
                    yield from self._wait(lang, held, lengths, len(held))
                    held, lengths = [], []
        if held:
            yield from self._wait(lang, held, lengths, len(held))

    def _wait(self, lang: str, words: list[bytes], lengths: list[int] | None, n: int) -> Iterator[tuple[str, int, bytes]]:
        known = self.ids.get(lang)
        if known is None:
            known = self.ids[lang] = WordIds(lang, self.words, self.frequent, self.codes)
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        pieces = np.zeros(len(ids), np.int64) if lengths is None else np.repeat(np.arange(len(lengths)), lengths)
        # a rare word opens a piece, and is left out; the second word of a rare pair opens one
        first, rest = windows(ids, pieces + np.cumsum((ids == 0) | self._opens(ids)))
        kept = np.flatnonzero(ids[:n])
        self.pruned[lang] = self.pruned.get(lang, 0) + n - len(kept)
        self.waiting.setdefault(lang, []).append((first[kept], rest[kept]))
        self.n_waiting[lang] = self.n_waiting.get(lang, 0) + len(kept)
        if self.n_waiting[lang] >= CHUNK:
            self._insert(lang)
        if sum(self.n_waiting.values()) >= 4 * CHUNK or self.many_words():
            for other in list(self.waiting):
                self._insert(other)
        if self.full():
            yield from self.spill()

    def _opens(self, ids: np.ndarray) -> np.ndarray:
        """Whether a word is the second one of a rare pair."""
        opens = np.zeros(len(ids), bool)
        if self.pairs is not None:
            codes = np.array(self.codes, np.uint64)[ids]
            at = pair_slots(codes[:-1], codes[1:]).view(np.int64) & PAIR_BITS - 1
            opens[1:] = self.pairs[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 0
        return opens

    def _insert(self, lang: str) -> None:
        parts = self.waiting.pop(lang, [])
        self.n_waiting[lang] = 0
        if parts:
            first, rest = (np.concatenate(c) for c in zip(*parts))
            self.tries.setdefault(lang, HatTrie()).insert(first, rest)

    def full(self) -> bool:
        return sum(t.size for t in self.tries.values()) > self.entries or self.many_words()

    def many_words(self) -> bool:
        return sum(map(len, self.ids.values())) > VOCABULARY

    def spill(self, everything: bool = False) -> Iterator[tuple[str, int, bytes]]:
        """(language, prefix partition, front-coded run) of the subtrees that leave."""
        everything = everything or self.many_words()
        if everything:
            for lang in list(self.waiting):
                self._insert(lang)
        words = self.words
        known = len(self.hashes)
        self.hashes = np.concatenate([self.hashes, word_hashes(words[known:])])
        total = sum(t.size for t in self.tries.values())
        for lang, trie in self.tries.items():
            keep = 0 if everything else trie.size // 2 if 2 * trie.size * len(self.tries) >= total else trie.size
            first, rest, count = trie.take(keep)
            if len(first):
                columns = [first] + [rest >> (ID_BITS * k) & ID_MASK for k in range(WORDS - 1)]
                yield from coded_runs(lang, *phrase_counts(columns, count), words, self.hashes, self.buckets)
        if everything:
            yield from ((lang, PRUNED, struct.pack("<q", n)) for lang, n in self.pruned.items() if n)
            self._renew()


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def prefix_partition(table: np.ndarray, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The partition of phrases, by a hash of their first three words."""
    key = np.zeros(len(table), np.uint64)
    for k in range(WORDS - 1):
        key = (key ^ hashes[table[:, k]]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return (key % np.uint64(buckets)).astype(np.int64)


def coded_runs(
    lang: str, table: np.ndarray, depth: np.ndarray, count: np.ndarray, words: list[bytes], hashes: np.ndarray, buckets: int
) -> Iterator[tuple[str, int, bytes]]:
    """The sorted phrases dealt to prefix partitions, each part front coded."""
    bucket = prefix_partition(table, hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    table, depth, count, bucket = table[order], depth[order], count[order], bucket[order]
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    for i, j in zip(cuts, cuts[1:]):
        yield lang, int(bucket[i]), encode_run(table[i:j], depth[i:j], count[i:j], words)


def encode_run(table: np.ndarray, depth: np.ndarray, count: np.ndarray, words: list[bytes]) -> bytes:
    """A run as its shapes (shared words and words of each phrase), counts (one
    byte, larger ones apart), the words that are new to each phrase as numbers
    into the run's own word list, and that list; compressed."""
    import zstandard

    same = np.cumprod(table[1:] == table[:-1], axis=1).sum(axis=1)
    shared = np.concatenate([[0], np.minimum(same, depth[1:] - 1)])
    column = np.arange(WORDS)
    new = (column >= shared[:, None]) & (column < depth[:, None])
    own, codes = np.unique(table[new], return_inverse=True)
    codes = codes.astype("<u2" if len(own) <= 1 << 16 else "<u4")
    large = count[count >= 255].astype("<i8")
    head = np.array([len(table), len(large), len(codes), codes.itemsize], "<i8")
    shapes = (shared * 8 + depth).astype(np.uint8)
    small = np.minimum(count, 255).astype(np.uint8)
    text = b" ".join(map(words.__getitem__, own.tolist()))
    parts = [x.tobytes() for x in (head, large, codes, shapes, small)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*parts, text]))


def decode_run(raw: bytes, words: list[bytes], ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x 4 word ids, counts) of a run with the given word list."""
    n, n_large, n_codes, width = np.frombuffer(raw, "<i8", 4).tolist()
    at = 32
    large = np.frombuffer(raw, "<i8", n_large, at)
    at += 8 * n_large
    codes = np.frombuffer(raw, f"<u{width}", n_codes, at)
    at += width * n_codes
    shapes = np.frombuffer(raw, np.uint8, n, at)
    count = np.frombuffer(raw, np.uint8, n, at + n).astype(np.int64)
    count[count == 255] = large
    known = np.fromiter(map(ids.__getitem__, words), np.int32, len(words))
    shared, depth = shapes >> 3, shapes & 7
    column = np.arange(WORDS)
    new = (column >= shared[:, None]) & (column < depth[:, None])
    table = np.zeros((n, WORDS), np.int32)
    table[new] = known[codes]
    # A shared word is that of the last row which wrote this column.
    rows = np.arange(n)[:, None]
    source = np.maximum.accumulate(np.where(new, rows, 0), axis=0)
    table = np.take_along_axis(table, source, axis=0)
    table[column >= depth[:, None]] = 0
    return table, count


def run_words(raw: bytes) -> list[bytes]:
    """The word list at the end of a run."""
    n, n_large, n_codes, width = np.frombuffer(raw, "<i8", 4).tolist()
    return raw[32 + 8 * n_large + width * n_codes + 2 * n :].split(b" ")


def merged(runs: list[bytes], min_count: int) -> tuple[list[bytes], np.ndarray, int]:
    """Phrases of at least ``min_count`` occurrences with their counts, and the
    number of words, over all runs of one language and prefix partition."""
    import zstandard

    plain = list(map(zstandard.ZstdDecompressor().decompress, runs))
    lists = list(map(run_words, plain))
    words = [b"", *dict.fromkeys(chain.from_iterable(lists))]
    ids = dict(zip(words, range(len(words))))
    parts = [decode_run(r, w, ids) for r, w in zip(plain, lists)]
    table, count = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    single = int(count[table[:, 1] == 0].sum())
    low, high = (table[:, k].astype(np.int64) << 32 | table[:, k + 1] for k in (2, 0))
    order = np.lexsort((low, high))
    low, high = low[order], high[order]
    starts = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
    totals = np.add.reduceat(count[order], starts)
    often = totals >= min_count
    phrases = [b" ".join([words[i] for i in row if i]) for row in table[order[starts[often]]].tolist()]
    return phrases, totals[often], single


def frequent_phrases(
    docs: DataFrame, min_count: int = 30, text_col: str = "text", lang_col: str = "lang", entries: int = ENTRIES
) -> DataFrame:
    """(lang, phrase, f) of the phrases of 1 to 4 words with ``min_count``
    occurrences; the rows with an empty phrase add up to the language's n."""
    spark = docs.sparkSession
    ship(spark)
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("phrases")
        state = TaskCounts(buckets, entries, frequent.value, pairs.value)
        kinds = {"lang": pa.string(), "bucket": pa.int64(), "run": pa.binary()}
        for lang, texts in _lang_texts(batches):
            yield from _run_batches(state.add(lang, texts), kinds)
        yield from _run_batches(state.spill(everything=True), kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, bucket), runs in _run_groups(batches):
            if bucket == PRUNED:
                phrases, totals, single = [], np.zeros(0, np.int64), sum(struct.unpack("<q", r)[0] for r in runs)
            else:
                phrases, totals, single = merged(runs, min_count)
            found = [lang] * (len(phrases) + 1), [*phrases, b""], [*totals.tolist(), single]
            kinds = (pa.string(), pa.binary(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(found, kinds)]
            columns[1] = columns[1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang")
    texts = docs.select(lang, F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    frequent = spark.sparkContext.broadcast(frequent_words(texts, min_count))
    pairs = spark.sparkContext.broadcast(frequent_pairs(texts, min_count, frequent, buckets))
    runs = texts.mapInArrow(count, "lang string, bucket long, run binary")
    # lang is part of the key, so a partition of one language is never met with another's
    dealt = runs.repartition("bucket", "lang").sortWithinPartitions("bucket", "lang")
    return dealt.mapInArrow(merge, "lang string, phrase string, f long")


def _run_batches(runs: Iterator[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is a run, in batches of some MB."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds.values())], list(kinds))

    for row in runs:
        held.append(row)
        size += len(row[-1])
        if size > 1 << 22 or len(held) == 1000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _run_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes]]]:
    """The runs of equal keys (all columns but the last) at a time, from sorted rows."""
    key, held = None, []
    for batch in batches:
        for *found, run in zip(*(c.to_pylist() for c in batch.columns)):
            if tuple(found) != key:
                if held:
                    yield key, held
                key, held = tuple(found), []
            held.append(run)
    if held:
        yield key, held


# -- scoring ----------------------------------------------------------------
def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    min_count: int = 30,
    covered: int = 80,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
    entries: int = ENTRIES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to 4
    words of each language by score, a, phrase. A phrase inside a longer one
    with ``covered`` percent of its occurrences is left out."""
    return scored(materialize(frequent_phrases(docs, min_count, text_col, lang_col, entries), "phrases"), covered, top)


def scored(counted: DataFrame, covered: int, top: int) -> DataFrame:
    """The collocations of a table (lang, phrase, f) of frequent phrases."""
    totals = counted.where("phrase = ''").groupBy("lang").agg(F.sum("f").alias("n"))
    words = F.split("phrase", " ")
    phrases = counted.where("phrase <> ''")
    candidates = phrases.withColumnRenamed("f", "a").withColumn("words", words).where(F.size("words") > 1)

    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    both = both.withColumn("a_", F.lit(2000000).cast("decimal(7,0)") * _exact("a")).withColumn("lr_", _exact("l") + _exact("r"))
    both = both.withColumn("score", F.expr("a_ div lr_"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))

    inside = candidates.where(F.size("words") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inside = inside.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)))
    longer = inside.select("lang", part(F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = best.join(longer, ["lang", "phrase"], "left")
    hidden = F.col("longest").isNotNull() & (F.lit(100).cast("decimal(3,0)") * _exact("longest") >= F.lit(covered).cast("decimal(3,0)") * _exact("a"))
    kept = kept.where(~hidden).select("lang", "phrase", "a", "b.l", "b.r", "b.score")

    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(top))
    ranked = ranked.withColumn("rank", F.col("rank").cast("long"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
