"""Near-duplicate documents by b-bit MinHash.

1. Every whole text becomes its set of distinct word shingles (64-bit hashes)
   and ``K`` minima of seeded hash functions. Only the low ``BITS`` bits of a
   minimum are kept, packed into a signature; ``band_rows(threshold)`` minima
   at a time give the keys of the bands.
2. Documents with equal sets (copies) collapse to one class before anything
   is paired.
3. Classes sharing a band key are candidates. Each bucket contributes a star
   (its smallest class to the others, never all pairs) and the connected
   components of the stars are the candidate clusters: two classes that share
   a band are always in one cluster.
4. Inside a cluster signatures are compared by bit counts; the collision
   corrected estimate ``(equal - 2**-BITS) / (1 - 2**-BITS)`` must come within
   five standard deviations of the threshold, and the link is then confirmed
   on the full sets. Clusters over ``BLOCK`` classes are cut into blocks and
   every pair of blocks is a group of its own, so no task holds more than two
   blocks. A group emits a spanning forest of its confirmed links, which
   keeps every component and is never longer than the group.
5. The components of the confirmed links are the classes of near duplicates.

The rows of a band follow the threshold, so that a pair at the threshold shares
no band with probability under ``MISS`` (2e-9): 51 bands of 5 at 0.8, 85 of 3
at 0.6, 128 of 2 at 0.5. Thresholds that 256 bands of 1 don't reach raise.

Words are maximal runs of bytes other than space and 0x09-0x0D after A-Z are
lower-cased. Defined results: a NULL, empty or blank text has no shingles and
is linked with nothing; a text with fewer words than a shingle has its whole
word sequence as its one element; rows that repeat an id are labelled each by
its own text (and an id links nothing by itself); a row with a NULL id has a NULL component and is kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.batches import text_slices
from playlens.llm.common import ship
from playlens.llm.components import components
from playlens.llm.workercache import BoundedCache, hold, release

BITS = 4
K = 256
#: Most minima in a band, and the largest share of pairs at the threshold without a common band.
MOST_ROWS, MISS = 5, 2e-9
BLOCK = 512
#: Shingles handled at a time by one hash function (fits a core's cache).
CHUNK = 1 << 16


# -- shingles ---------------------------------------------------------------
class WordHashes(BoundedCache):
    """word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        self.keep(word, value)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(hold("shingle-words", WordHashes).__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    out = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        out = _mix(out + hashed[k : len(words) - span + 1 + k])
    return np.unique(out)


# -- signatures -------------------------------------------------------------
def band_rows(threshold: float) -> int:
    """The most minima a band may have to miss under ``MISS`` of the pairs at the threshold."""
    for rows in range(MOST_ROWS, 0, -1):
        if (1 - threshold**rows) ** (K // rows) <= MISS:
            return rows
    raise ValueError(f"threshold {threshold} is too low for {K} minima")


def _functions(rows: int = MOST_ROWS, seed: int = 29) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    masks = rng.integers(0, 1 << 32, K, dtype=np.uint32)
    factors = rng.integers(0, 1 << 31, K, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    band_factors = rng.integers(0, 1 << 63, (K // rows, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return masks, factors, band_factors


_MASKS, _FACTORS, _ = _functions()
_BAND_FACTORS = {rows: _functions(rows)[2] for rows in range(1, MOST_ROWS + 1)}


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The K minima of every (non-empty) set, one row a set."""
    out = np.empty((len(sets), K), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first + 1, len(sets[first])
        while last < len(sets) and total + len(sets[last]) <= CHUNK:
            total += len(sets[last])
            last += 1
        x = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[first : last - 1]])]).astype(np.intp)
        v = np.empty_like(x)
        for k in range(K):
            np.bitwise_xor(x, _MASKS[k], out=v)
            np.multiply(v, _FACTORS[k], out=v)
            out[first:last, k] = np.minimum.reduceat(v, starts)
        first = last
    return out


def band_keys(mins: np.ndarray, rows: int = MOST_ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` minima; the band's number is part of the key."""
    bands = K // rows
    grouped = mins[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix((grouped * _BAND_FACTORS[rows]).sum(axis=2, dtype=np.uint64) + key).view(np.int64)


def pack(mins: np.ndarray) -> np.ndarray:
    """The low BITS bits of every minimum, 64 // BITS to a 64-bit word."""
    per = 64 // BITS
    low = (mins & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(mins), -1, per)
    return (low << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures by bit counts."""
    x = a ^ b
    for shift in (1, 2)[: BITS.bit_length() - 1]:
        x |= x >> np.uint64(shift)
    unit = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    equal = 1 - np.bitwise_count(x & unit).sum(axis=-1) / K
    return (equal - 0.5**BITS) / (1 - 0.5**BITS)


def estimate_floor(threshold: float) -> float:
    """Five standard deviations of the estimate under the threshold."""
    c = 0.5**BITS
    equal = c + (1 - c) * threshold
    return threshold - 5 * float(np.sqrt(equal * (1 - equal) / K)) / (1 - c)


def signatures(docs: DataFrame, size: int, id_col: str, text_col: str, rows: int = MOST_ROWS) -> DataFrame:
    """(uid, id, h, n, k1, k2, bands, sig) of every row: uid is its own number
    (once written), h the hash of its text; k1, k2 are two independent 64-bit
    sums over the set that stand for it."""
    ship(docs.sparkSession)
    names = ["id", "h", "n", "k1", "k2", "bands", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, 1, 4 << 20):
            sets = [shingle_set(t, size) for t in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            keys = np.zeros((2, len(sets)), np.int64)
            bands, sig = [[] for _ in sets], [b""] * len(sets)
            if len(full):
                mins = minima([sets[i] for i in full])
                found, packed = band_keys(mins, rows), pack(mins)
                for row, i in enumerate(full):
                    bands[i], sig[i] = found[row], packed[row].tobytes()
                    for k in range(2):
                        total = _mix(sets[i] + np.uint64(k + 1)).sum(dtype=np.uint64)
                        keys[k, i] = total.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes),
                    pa.array(keys[0]),
                    pa.array(keys[1]),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sig, pa.binary()),
                ],
                names,
            )
        release()

    text = F.col(text_col).cast("string")
    out = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    found = out.mapInArrow(run, "id long, h long, n long, k1 long, k2 long, bands array<long>, sig binary")
    return found.withColumn("uid", F.monotonically_increasing_id())


# -- clusters and links -----------------------------------------------------
def candidate_clusters(classes: DataFrame) -> DataFrame:
    """(node, cluster) of the classes that share a band with another class."""
    index = classes.select("node", F.explode("bands").alias("key"))
    buckets = index.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("_last")).where("a < _last")
    stars = index.join(buckets.drop("_last"), "key").where("node > a").select("a", F.col("node").alias("b"))
    return components(stars).withColumnRenamed("component", "cluster")


def confirmed_links(docs: DataFrame, classes: DataFrame, size: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(a, b): a spanning forest of the links of every group of classes."""
    clusters = materialize(candidate_clusters(classes), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = clusters.join(sizes, "cluster").withColumn("own", own)
    signed = members.join(classes.select("node", "id", "h", "n", "k1", "sig"), "node")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    # one row a class, however often its row is repeated
    with_text = texts.join(signed, ["id", "h"]).dropDuplicates(["id", "h"])
    names = ["cluster", "low", "high", "node", "own", "sig", "shingles"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The full set of every class, once for each group it belongs to."""
        out, held = [[] for _ in names], 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                for r in whole.slice(at, 256).to_pylist():
                    found = shingle_set(r["text"].encode(), size)
                    if len(found) != r["n"] or _mix(found + np.uint64(1)).sum(dtype=np.uint64).view(np.int64) != r["k1"]:
                        continue  # another text with the same id and hash
                    for other in range(r["blocks"]):
                        low, high = sorted((r["own"], other))
                        for column, value in zip(out, (r["cluster"], low, high, r["node"], r["own"], r["sig"], found.tobytes())):
                            column.append(value)
                        held += 8 * len(found)
                        if held > 1 << 23:
                            yield flush()
                            out, held = [[] for _ in names], 0
        yield flush()

    needed = with_text.select("node", "text", "cluster", "own", "blocks", "n", "k1", "sig").where(F.col("text").isNotNull())
    schema = "cluster long, low int, high int, node long, own int, sig binary, shingles binary"
    groups = needed.mapInArrow(sets_of, schema)
    keys = ["cluster", "low", "high"]
    dealt = groups.repartition(*keys).sortWithinPartitions(*keys)
    floor = estimate_floor(threshold)

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            a, b = forest(group, threshold, floor)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(forests, "a long, b long")


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of each run of equal keys (the first ``n_keys`` columns) of a
    sorted partition, one run at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            key = tuple(keys[start].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def forest(group: pa.Table, threshold: float, floor: float) -> tuple[list[int], list[int]]:
    """Links of one group, likeliest pairs first, leaving out pairs that
    earlier links already join. In a group of two blocks only pairs across
    the blocks count; each block's own pairs are in a group of their own."""
    nodes, first = np.unique(group.column("node").to_numpy(), return_index=True)
    if len(nodes) < 2:
        return [], []
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint64).reshape(len(group), -1)[first]
    raw = group.column("shingles").to_pylist()
    sets = [np.frombuffer(raw[i], np.uint64) for i in first]
    sizes = np.array([len(s) for s in sets])
    own = group.column("own").to_numpy()[first]
    across = group.column("low")[0].as_py() != group.column("high")[0].as_py()
    pairs = []
    for i in range(len(nodes) - 1):
        near = similarity(sig[i], sig[i + 1 :])
        fits = (near >= floor) & (np.minimum(sizes[i], sizes[i + 1 :]) >= threshold * np.maximum(sizes[i], sizes[i + 1 :]) - 1e-9)
        if across:
            fits &= own[i + 1 :] != own[i]
        pairs += [(-near[j], i, i + 1 + j) for j in np.flatnonzero(fits)]
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a, b = [], []
    for _, i, j in sorted(pairs):
        p, q = root(i), root(j)
        if p == q:
            continue
        shared = sizes[i] + sizes[j] - len(np.union1d(sets[i], sets[j]))
        if linked(int(shared), int(sizes[i]), int(sizes[j]), threshold):
            parent[max(p, q)] = min(p, q)
            a.append(int(nodes[i]))
            b.append(int(nodes[j]))
    return a, b


def linked(shared: int, n: int, m: int, threshold: float) -> bool:
    """Whether intersection / union reaches the threshold, in whole hundredths."""
    return 100 * shared >= round(100 * threshold) * (n + m - shared)


def near_duplicates(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: component_id is the
    smallest id reachable over links, kept marks the row it belongs to."""
    out = labelled(docs, size, threshold, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def labelled(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, h, n, component, component_id, kept) of every row, h being
    ``xxhash64`` of its text and component the number of its group (NULL without
    shingles), which tell the rows of a repeated id apart."""
    signed = materialize(signatures(docs, size, id_col, text_col, band_rows(threshold)), "signatures")
    key = ["k1", "k2", "n"]
    # A class is a distinct set and its node the number of one of its rows: an
    # id may hold several texts, and a row may be repeated.
    least = signed.where("n > 0 AND id IS NOT NULL").groupBy(*key).agg(F.min(F.struct("id", "uid")).alias("m"))
    least = materialize(least.select(*key, F.col("m.id").alias("least"), F.col("m.uid").alias("node")), "least")
    classes = signed.join(least.select(F.col("node").alias("uid")), "uid", "left_semi").withColumnRenamed("uid", "node")
    classes = materialize(classes, "classes")
    found = components(confirmed_links(docs, classes, size, threshold, id_col, text_col))
    labels = least.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labels = materialize(labels.select(*key, "least", "component"), "labels")
    smallest = labels.groupBy("component").agg(F.min("least").alias("smallest"))
    labels = labels.join(smallest, "component").select(*key, "component", "smallest")
    return (
        signed.select("id", "h", *key)
        .join(labels, key, "left")
        .select(
            "id",
            "h",
            "n",
            "component",
            F.when(F.col("id").isNotNull(), F.coalesce("smallest", "id")).alias("component_id"),
            F.coalesce(F.coalesce("smallest", "id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )
