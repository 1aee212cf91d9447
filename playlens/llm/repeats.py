"""Removing repeated byte strings: every byte covered by a string of
``length`` bytes that also starts earlier (in a smaller id, or earlier in the
same document) is removed; strings are judged on the input.

The suffix order of the whole collection is never built, because only common
prefixes of ``length`` bytes matter. Instead:

1. *Anchors.* In every window of ``length`` bytes the k-gram with the smallest
   hash (the leftmost on ties) is its anchor. The choice depends on the bytes
   of the window alone, so equal windows have equal anchors at equal places.
   Anchors whose k-gram occurs once in the collection need nothing more.
2. *Contexts.* Around each repeated anchor, the bytes that a window with it
   can reach are its context, aligned at the anchor. Equal contexts collapse
   to their first occurrence; at every later one each window is a repeat.
3. *Columns.* The distinct contexts of one anchor are the documents of a
   column-wise construction: each round inserts one symbol per document, the
   symbols of one column, in front of the suffixes known so far. The order of
   the new suffixes follows from the Burrows-Wheeler transform of the column
   (a stable sort of the symbols in the order of the old suffixes) and their
   common prefixes from range minima over the old ones. A run of suffixes
   with common prefixes of ``length`` or more is one repeated string; all but
   its earliest start are repeats.

Since windows of one anchor are aligned, a column's suffixes need comparing
only with each other, and each collection takes ``2 * length - k`` rounds
however long the documents are. The collections are Spark partitions sorted by
anchor and streamed run by run, which takes the place of the sequential files.
Anchors with more than ``hot`` distinct contexts are not put into one task:
their windows are compared by 128-bit hashes with a partial aggregate.

Defined results: a NULL text is empty; matches never cross documents; a NULL
id sorts after all others; rows with one id are ordered by their text's hash,
and rows equal in id and text share one result; texts shorter than ``length``
are kept whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.common import ship
from playlens.llm.workercache import hold

#: A position is part * 2**PART + byte; part numbers the texts of one id.
PART = 40
#: Bytes handled at a time, and the low bits that hold a position among them.
SEGMENT, LOW = 1 << 22, 23
LAST_ID = (1 << 63) - 1
#: Contexts per column-wise collection (whole anchors, at least one).
COLLECTION = 20_000


def gram_of(length: int) -> int:
    """The k of the anchor k-grams."""
    return max(1, length // 4)


def _powers(seed: int, n: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTES = _powers(41, 256)
_BASE = 0x9E3779B97F4A7C15


# -- anchors ----------------------------------------------------------------
def _doubled(first: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over runs of ``size`` neighbours, by doubling; join(a, b, n)
    combines a run with the run of n elements that follows it."""
    out, have, power, width = None, 0, first, 1
    while True:
        if size & width:
            if out is None:
                out, have = power, width
            else:  # the run in front has ``width`` elements
                n = min(len(power), len(out) - width)
                out, have = join(power[:n], out[width : width + n], have), have + width
        if width * 2 > size:
            return out
        power = join(power[:-width], power[width:], width)
        width *= 2


def gram_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """64-bit rolling hashes of all k-grams."""
    join = lambda a, b, n: a * np.uint64(pow(_BASE, n, 1 << 64)) + b
    h = _doubled(_BYTES[raw], k, join)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of the anchors of whole texts."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            found.append(_segment_anchors(held, length))
        held, size = [], 0

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SEGMENT - length + 1):
            part = text[at : at + SEGMENT]
            if len(part) < length:
                continue
            if size + len(part) > SEGMENT // 16 and held:
                flush()
            held.append((i, at, part))
            size += len(part)
    flush()
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    doc, pos, gram = (np.concatenate(x) for x in zip(*found))
    if any(len(t) > SEGMENT for t in texts):  # segments of one text overlap
        _, once = np.unique((doc << PART) + pos, return_index=True)
        doc, pos, gram = doc[once], pos[once], gram[once]
    return doc, pos, gram


def _segment_anchors(parts: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hold("repeats")
    k = gram_of(length)
    raw = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    ends = np.cumsum(sizes)
    gram = gram_hashes(raw, k)
    mask = np.uint64((1 << LOW) - 1)
    ranked = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
    least = _doubled(ranked, length - k + 1, lambda a, b, n: np.minimum(a, b))
    inside = np.ones(len(least), bool)
    for end in ends[:-1]:
        inside[max(0, end - length + 1) : end] = False
    chosen = np.zeros(len(raw), bool)
    chosen[(least[inside] & mask).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    part = np.searchsorted(ends, at, side="right")
    docs = np.array([d for d, _, _ in parts])
    base = np.array([o for _, o, _ in parts]) - (ends - sizes)
    return docs[part], at + base[part], gram[at].view(np.int64)


# -- contexts ---------------------------------------------------------------
def contexts(text: bytes, positions: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of symbols around anchors (1 + byte; 0 outside the text), and the
    first and last byte of each context."""
    k = gram_of(length)
    side = length - k
    symbols = np.zeros(len(text) + 2 * side, np.uint16)
    symbols[side : side + len(text)] = np.frombuffer(text, np.uint8).astype(np.uint16) + 1
    rows = symbols[positions[:, None] + np.arange(2 * side + k)]
    return rows, np.maximum(positions - side, 0), np.minimum(positions + k + side, len(text))


def row_hash(rows: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of every row of symbols."""
    weights, symbols = _powers(seed, rows.shape[1]), _powers(seed + 1, 257)
    out = np.zeros(len(rows), np.uint64)
    for c in range(rows.shape[1]):
        out += symbols[rows[:, c]] * weights[c]
        out ^= out >> np.uint64(37)
    return out.view(np.int64)


# -- column-wise construction -----------------------------------------------
def repeated_windows(rows: np.ndarray, age: np.ndarray, length: int) -> np.ndarray:
    """``out[i, j]``: whether the window of ``length`` symbols of document i
    from column j occurs in a document of smaller age at the same column.

    Columns are inserted from the last to the first. ``order`` holds the
    documents by their suffix from the current column, ``lcp[i]`` the symbols
    that the suffixes of order[i - 1] and order[i] share. The symbol 0 ends a
    text and equals nothing, itself included.
    """
    m, width = rows.shape
    out = np.zeros((m, width - length + 1), bool)
    order, lcp = np.arange(m), np.zeros(m, np.int32)
    for column in range(width - 1, -1, -1):
        bwt = rows[order, column]
        place = np.argsort(bwt, kind="stable")
        same = np.flatnonzero((bwt[place[1:]] == bwt[place[:-1]]) & (bwt[place[1:]] != 0)) + 1
        new = np.zeros(m, np.int32)
        new[same] = 1 + range_minima(lcp, place[same - 1] + 1, place[same])
        order, lcp = order[place], new
        if column < out.shape[1] and m > 1:
            heads = np.flatnonzero(lcp < length)
            eldest = np.minimum.reduceat(age[order], heads)
            run = np.cumsum(lcp < length) - 1
            out[order, column] = age[order] > eldest[run]
    return out


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first..last]) for ranges of at least one element."""
    span = last - first + 1
    out = np.empty(len(first), values.dtype)
    table, width, level = values, 1, np.frexp(span)[1] - 1
    for step in range(int(level.max(initial=0)) + 1):
        here = np.flatnonzero(level == step)
        out[here] = np.minimum(table[first[here]], table[last[here] - width + 1])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table
        width *= 2
    return out


# -- the job ----------------------------------------------------------------
def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, part, text): distinct (id, text) rows; part numbers the texts of
    one id and is 0 where ids are unique."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("d"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    repeated = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d")
    if repeated.isEmpty():
        return rows.select("d", F.lit(0).cast("long").alias("part"), "text")
    by_text = Window.partitionBy("d").orderBy("t")
    parts = rows.select("d", F.xxhash64("text").alias("t")).join(repeated, "d", "left_semi").distinct()
    parts = parts.select("d", "t", (F.row_number().over(by_text) - 1).cast("long").alias("_part"))
    named = rows.withColumn("t", F.xxhash64("text")).join(parts, ["d", "t"], "left")
    return named.select("d", F.coalesce("_part", F.lit(0)).alias("part"), "text")


def _anchor_rows(rows: DataFrame, length: int, with_place: bool) -> DataFrame:
    """(gram[, d, p]) of every anchor."""
    schema = "gram long" + ", d long, p long" * with_place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                doc, pos, gram = anchors(batch.column(2).cast(pa.binary()).to_pylist(), length)
                columns = [pa.array(gram)]
                if with_place:
                    d, part = (batch.column(c).to_numpy() for c in range(2))
                    columns += [pa.array(d[doc]), pa.array((part[doc] << PART) + pos)]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "d", "p"][: len(columns)])

    return rows.select("d", "part", "text").mapInArrow(run, schema)


def _context_rows(affected: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """(gram, context, d, p, lo, hi[, bytes]) of the anchors in ``places``;
    gram and context are independent 64-bit hashes and stand for a context
    together."""
    names = ["gram", "context", "d", "p", "lo", "hi"] + ["bytes"] * with_bytes
    side = length - gram_of(length)

    def made(held: list[tuple]) -> pa.RecordBatch:
        rows, d, p, lo, hi = (np.concatenate(x) for x in list(zip(*held))[:5])
        columns = [row_hash(rows[:, side : side + gram_of(length)], 61), row_hash(rows, 71), d, p, lo, hi]
        columns = [pa.array(c.astype(np.int64)) for c in columns]
        if with_bytes:
            columns.append(pa.array([x for h in held for x in h[5]], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                columns = [c.to_pylist() for c in whole.slice(at, 64).columns]
                for d, text, places in zip(columns[0], columns[1], columns[2]):
                    text, p = text.encode(), np.array(places, np.int64)
                    rows, lo, hi = contexts(text, p & ((1 << PART) - 1), length)
                    own = [text[a:b] for a, b in zip(lo.tolist(), hi.tolist())] if with_bytes else []
                    held.append((rows, np.full(len(p), d), p, lo, hi, own))
                    size += len(p)
                    if size >= 1 << 14:
                        yield made(held)
                        held, size = [], 0
        if held:
            yield made(held)

    schema = "gram long, context long, d long, p long, lo long, hi long" + ", bytes binary" * with_bytes
    return affected.select("d", "text", "places").mapInArrow(run, schema)


def aligned(held: list[bytes], left: np.ndarray, length: int) -> np.ndarray:
    """Rows of symbols of contexts given by their bytes and the number of
    bytes in front of the anchor."""
    side, width = length - gram_of(length), 2 * length - gram_of(length)
    sizes = np.array([len(x) for x in held], np.int64)
    out = np.zeros(len(held) * width, np.uint16)
    first = np.arange(len(held)) * width + side - left
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    out[at] = np.frombuffer(b"".join(held), np.uint8).astype(np.uint16) + 1
    return out.reshape(len(held), width)


def _intervals(d: np.ndarray, p: np.ndarray, hit: np.ndarray, length: int) -> pa.RecordBatch:
    """(d, part, a, b): byte ranges covered by the marked windows, one row for
    each run of marked windows of a context."""
    side = length - gram_of(length)
    edges = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edges == 1)
    _, stop = np.nonzero(edges == -1)
    at = p[row] & ((1 << PART) - 1)
    columns = [d[row], p[row] >> PART, at - side + start, at - side + stop - 1 + length]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["d", "part", "a", "b"])


_INTERVALS = "d long, part long, a long, b long"


def _column_wise(wanted: DataFrame, length: int) -> DataFrame:
    """Repeated windows among the distinct contexts of every anchor."""

    def build(tables: list[pa.Table]) -> pa.RecordBatch:
        whole = pa.concat_tables(tables)
        d, p, lo = (whole.column(c).to_numpy() for c in ("d", "p", "lo"))
        rows = aligned(whole.column("bytes").to_pylist(), (p & ((1 << PART) - 1)) - lo, length)
        age = np.empty(len(d), np.int64)
        age[np.lexsort((p, d))] = np.arange(len(d))
        return _intervals(d, p, repeated_windows(rows, age, length), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playlens.llm.minhash import runs

        held, size = [], 0
        for group in runs(batches, 1):
            held.append(group)
            size += len(group)
            if size >= COLLECTION:
                yield build(held)
                held, size = [], 0
        if held:
            yield build(held)

    dealt = wanted.select("gram", "d", "p", "lo", "bytes").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, _INTERVALS)


def _by_windows(wanted: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many contexts for one task: every window
    is a row, the first of equal windows is found by a partial aggregate."""
    side = length - gram_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                d, p, lo = (batch.column(c).to_numpy() for c in range(3))
                rows = aligned(batch.column(3).to_pylist(), (p & ((1 << PART) - 1)) - lo, length)
                for j in range(side + 1):
                    window = rows[:, j : j + length]
                    full = np.flatnonzero((window != 0).all(axis=1))
                    if len(full):
                        columns = [row_hash(window[full], 91), row_hash(window[full], 95), d[full], p[full] - side + j]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["w1", "w2", "d", "s"])

    windows = wanted.select("d", "p", "lo", "bytes").mapInArrow(run, "w1 long, w2 long, d long, s long")
    first = windows.groupBy("w1", "w2").agg(F.min(F.struct("d", "s")).alias("first"), F.count(F.lit(1)).alias("n"))
    later = windows.join(first.where("n > 1"), ["w1", "w2"]).where("d > first.d OR (d = first.d AND s > first.s)")
    at = F.expr(f"s & {(1 << PART) - 1}L")
    return later.select("d", F.shiftright("s", PART).alias("part"), at.alias("a"), (at + length).alias("b"))


def repeated_bytes(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", hot: int = 100_000):
    """Returns (texts, intervals): texts has (d, part, n_bytes, sha, text,
    places, text_hash) per row, text and places only where an anchor repeats;
    intervals has (d, part, a, b), byte ranges to remove, which may overlap."""
    ship(docs.sparkSession)
    rows = _numbered(docs, id_col, text_col)
    counted = _anchor_rows(rows, length, with_place=False).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # Stored, so that the join below has plain shuffles on both sides and a
    # very common gram is split over tasks.
    repeated = materialize(counted.where("n > 1").select("gram"), "repeated-grams")
    placed = _anchor_rows(rows, length, with_place=True).join(repeated, "gram", "left_semi")
    part = F.shiftright("p", PART).alias("part")
    lists = placed.groupBy("d", part).agg(F.collect_list("p").alias("places"))
    lists = lists.withColumn("places", F.sort_array(F.array_distinct("places")))
    raw = F.col("text").cast("binary")
    texts = rows.join(lists, ["d", "part"], "left").select(
        "d",
        "part",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(F.col("places").isNull(), F.sha2(raw, 256)).alias("sha"),
        F.when(F.col("places").isNotNull(), F.col("text")).alias("text"),
        "places",
        F.xxhash64("text").alias("text_hash"),
    )
    texts = materialize(texts, "repeat-texts")
    affected = texts.where("places IS NOT NULL").dropDuplicates(["d", "part"]) if _has_repeated_rows(texts) else texts.where("places IS NOT NULL")

    key = ["gram", "context"]
    slim = _context_rows(affected, length, with_bytes=False)
    first = slim.groupBy(*key).agg(F.min(F.struct("d", "p")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.select(*key, F.col("first.d").alias("fd"), F.col("first.p").alias("fp"), "n"), "contexts")
    later = slim.where(f"hi - lo >= {length}").join(first.where("n > 1"), key).where("d <> fd OR p <> fp")
    later = materialize(later.select("d", part, F.col("lo").alias("a"), F.col("hi").alias("b")), "copied-contexts")

    spread = first.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
    wanted = first.select("gram", F.col("fd").alias("d"), F.col("fp").alias("p")).join(spread, "gram")
    wanted = wanted.groupBy("d", part).agg(F.sort_array(F.collect_list("p")).alias("places"))
    full = affected.select("d", "part", "text").join(wanted, ["d", "part"])
    full = _context_rows(full, length, with_bytes=True).where(f"hi - lo >= {length}")
    crowded = spread.where(f"contexts > {hot}").select("gram")
    if crowded.isEmpty():
        found = _column_wise(full, length)
    else:
        found = _column_wise(full.join(crowded, "gram", "left_anti"), length)
        found = found.unionByName(_by_windows(full.join(crowded, "gram", "left_semi"), length))
    return texts, later.unionByName(materialize(found, "repeated-windows"))


def _has_repeated_rows(texts: DataFrame) -> bool:
    """Whether a row of the table repeats another in id and text."""
    return not texts.groupBy("d", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def merged(ranges: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of sorted, possibly overlapping ranges."""
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((int(a), int(b)))
    return out


def remove_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False, hot: int = 100_000
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row. With
    ``with_kept`` also the maximal removed byte runs (spans), the remaining
    bytes (kept) and the remaining text, where a character that was cut
    through is left out (kept_text) - these three only where a span was
    looked for - and text_hash, the xxhash64 of the input text."""
    texts, intervals = repeated_bytes(docs, length, id_col, text_col, hot)
    lists = intervals.groupBy("d", "part").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("ranges"))
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "spans", "kept_text", "text_hash"] * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out = [[] for _ in names]
                texts = batch.column(2).cast(pa.binary()).to_pylist()
                for d, n, text, ranges, text_hash in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, *(batch.column(c).to_pylist() for c in (3, 4))):
                    spans = merged([(r["a"], r["b"]) for r in ranges or []])
                    keep, last = [], 0
                    for a, b in spans:
                        keep.append(text[last:a])
                        last = b
                    kept = b"".join([*keep, text[last:]])
                    row = [d, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, [list(s) for s in spans], kept.decode("utf-8", "ignore"), text_hash]
                    for column, value in zip(out, row):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64())), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary, spans array<array<long>>, kept_text string, text_hash long" * with_kept
    cut = texts.where("places IS NOT NULL").join(lists, ["d", "part"], "left").select("d", "n_bytes", "text", "ranges", "text_hash").mapInArrow(run, schema)
    zero = F.lit(0).cast("long")
    whole = texts.where("places IS NULL").select(
        F.col("d").alias("id"),
        "n_bytes",
        zero.alias("n_removed"),
        zero.alias("n_spans"),
        F.col("sha").alias("kept_sha256"),
        *([F.lit(None).cast(kind).alias(c) for c, kind in (("kept", "binary"), ("spans", "array<array<long>>"), ("kept_text", "string"))] + ["text_hash"] if with_kept else []),
    )
    return cut.unionByName(whole).withColumn("id", F.when(F.col("id") != LAST_ID, F.col("id"))).withColumnRenamed("id", id_col)
