"""Near-duplicate documents by SimHash and covering locality-sensitive hashing.

1. A whole text is lower-cased (A-Z), cut into words at space and 0x09-0x0D
   and into shingles of ``size`` words, repeats included. Bit i of its 64-bit
   fingerprint is 1 if it is set in over half of the shingles' XXH64 hashes
   (seed 42). Equal fingerprints collapse to one node.
2. Two fingerprints are linked if they differ in at most ``radius`` bits. Every
   bit position i has a vector m(i) of radius + 1 bits; table v (any non-zero
   vector) keeps the positions with <m(i), v> = 1. The differing positions of a
   pair give at most ``radius`` equations over radius + 1 unknowns, so some
   table keeps none of them: **every** pair within the radius collides in some
   table (Pagh, "CoveringLSH"). For radius 3 these are 15 masks of about half
   the bits each.
3. A bucket of at most ``LIMIT`` fingerprints is compared directly by bit
   counts. A larger one is covered again by 15 masks over the bits that are
   still free in it, where the same guarantee holds; at the third level about 7
   bits are free, so a bucket has at most some 128 fingerprints. No bucket is
   cut, and the rows made are a constant times the fingerprints.
4. A bucket gives a spanning forest of its links; the connected components of
   all links are the classes.

Defined results: a NULL, empty or blank text has no shingle and fingerprint
zero, linked like any other; a text with fewer words than a shingle has its
whole word sequence as its one shingle; rows that repeat an id are labelled
each by its own text; a row with a NULL id has its fingerprint and a NULL
component, and links nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.batches import sorted_groups, text_slices
from playlens.llm.common import ship
from playlens.llm.components import components

SEED = 42
#: Fingerprints of a bucket that are compared with each other directly.
LIMIT = 1024
#: Shingles hashed at a time.
CHUNK = 1 << 16


# -- fingerprints -----------------------------------------------------------
def fingerprint(text: bytes, size: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    span = min(size, len(words))
    total = len(words) - span + 1
    ones = np.zeros(64, np.int64)
    for first in range(0, total, CHUNK):
        part = words[first : first + min(CHUNK, total - first) + span - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        pairs = zip(starts[: len(part) - span + 1].tolist(), ends[span - 1 :].tolist())
        hashes = np.array([xxh64_intdigest(joined[i:j], SEED) for i, j in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 1):
            found = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["id", "fp"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, "id long, fp long")


# -- covering masks ---------------------------------------------------------
def covering_masks(fixed: int, radius: int) -> list[int]:
    """``fixed`` widened by each of the 2**(radius + 1) - 1 covering masks of the
    other bits, as unsigned 64-bit numbers."""
    n = (1 << (radius + 1)) - 1
    free = [i for i in range(64) if not fixed >> i & 1]
    vector = {i: 1 + k % n for k, i in enumerate(free)}
    return [fixed | sum(1 << i for i in free if (vector[i] & v).bit_count() % 2) for v in range(1, n + 1)]


def mask_levels(radius: int, limit: int) -> list[list[tuple[int, int]]]:
    """(parent mask, mask) pairs of each level, until no bucket can hold over ``limit``."""
    levels, parents = [], [0]
    while True:
        level = [(p, m) for p in parents for m in covering_masks(p, radius)]
        levels.append(level)
        parents = sorted({m for _, m in level if 1 << (64 - m.bit_count()) > limit and m.bit_count() < 64})
        if not parents or len(levels) == 3:
            return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# -- links ------------------------------------------------------------------
def links(nodes: DataFrame, radius: int = 3, limit: int = LIMIT) -> DataFrame:
    """(a, b): a spanning forest, for every bucket, of the pairs of distinct
    fingerprints (column ``fp``) within ``radius``."""
    spark = nodes.sparkSession
    levels = mask_levels(radius, limit)
    first = F.array(*[F.lit(_signed(m)).cast("long") for _, m in levels[0]])
    open_rows = nodes.select("fp", F.explode(first).alias("mask"))
    ready = None
    for k in range(len(levels)):
        keyed = open_rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        counted = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        found = materialize(keyed.join(counted, ["mask", "value"]), "simhash-buckets")
        last = k == len(levels) - 1
        small = (found if last else found.where(F.col("n") <= limit)).select("mask", "value", "fp")
        ready = small if ready is None else ready.unionByName(small)
        large = found.where(F.col("n") > limit)
        if last or large.isEmpty():
            break
        children = spark.createDataFrame([(_signed(p), _signed(m)) for p, m in levels[k + 1]], "mask long, finer long")
        # at most 15 ** 3 rows, whatever the corpus
        open_rows = large.join(F.broadcast(children), "mask").select("fp", F.col("finer").alias("mask"))
    dealt = ready.repartition("mask", "value").sortWithinPartitions("mask", "value")

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, fp), starts in sorted_groups(batches, 2):
            a, b = bucket_forests(fp, starts, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(forests, "a long, b long").distinct()


def bucket_forests(fp: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of the links of every bucket of a run of rows."""
    bits = fp.view(np.uint64)
    sizes = np.diff(starts)
    pair = starts[:-1][sizes == 2]
    near = pair[np.bitwise_count(bits[pair] ^ bits[pair + 1]) <= radius]
    a, b = [fp[near]], [fp[near + 1]]
    for s, n in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        group = bits[s : s + n]
        outside = np.ones(n, bool)  # not yet reached
        for seed in range(n):
            if not outside[seed]:
                continue
            outside[seed] = False
            front = [seed]
            while front:
                i = front.pop()
                rest = np.flatnonzero(outside)
                reached = rest[np.bitwise_count(group[rest] ^ group[i]) <= radius]
                outside[reached] = False
                front += reached.tolist()
                a.append(np.full(len(reached), fp[s + i]))
                b.append(fp[s + reached])
    return np.concatenate(a), np.concatenate(b)


def simhash_duplicates(
    docs: DataFrame, size: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) of every row: component_id is the
    smallest id reachable over links of at most ``radius`` differing bits."""
    signed = materialize(fingerprints(docs, size, id_col, text_col), "fingerprints")
    nodes = signed.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least"))
    nodes = materialize(nodes, "simhash-nodes")
    found = components(links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "component")
    labelled = materialize(nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "simhash-labels")
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = labelled.join(least, "component").select("fp", "component_id")
    return signed.join(labels, "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
