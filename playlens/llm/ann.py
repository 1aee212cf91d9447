"""Approximate nearest neighbours by multi-index hashing of learned codes.

1. Codes: vectors are centred and rotated, and the signs are the bits. The
   rotations are learned by iterative quantization (alternating between codes
   and the orthogonal rotation that brings the vectors closest to them) from
   several starts, which gives ``starts * dimension`` bits.
2. Radius: the Hamming radius holds the given share of the true neighbours
   within the sample, taken at the rank that matches the size of the table.
3. Index: codes are cut into 16-bit substrings, each indexed by value. A code
   within the radius agrees with the query in some substring up to
   ``radius // substrings`` bits (pigeonhole), so the values within that many
   flips retrieve every code within the radius.
4. What is retrieved and verified to lie within the radius is ranked by the
   exact inner product of the original vectors in double precision.

Codes, rotations and radius are fitted on at most ``sample`` rows (those with
the smallest hash of their id); every row is indexed. The stated queries run
against all rows in blocks: rows and queries are dealt to blocks of fixed
size, a group holds one block of each, and returns its best ``k`` per query.

Defined results: vectors that are NULL, zero, of another dimension than most,
or that hold NULL or non-finite components take no part, neither as queries
nor as candidates, and neither do rows without an id; a query's own id is
never a candidate; ties go to the smaller id; rows repeating an id and vector
count once; an empty table or no usable query gives an empty result. A query
with fewer than ``k`` codes within the radius is ranked over its whole block,
so it gets all candidates if there are fewer than ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import ship
from playlens.llm.minhash import runs

ROW_BLOCK, QUERY_BLOCK = 8192, 2048
SUBSTRING = 16
_ONES = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint16))


@dataclass
class CodeModel:
    """Centre, rotations (dimension x bits) and the Hamming radius."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Substrings of the codes of vectors, one row of uint16 each."""
        bits = (x - self.mean) @ self.rotation > 0
        pad = -bits.shape[1] % SUBSTRING
        packed = np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1, bitorder="little")
        return packed.view(np.uint16)


def quantizing_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """Iterative quantization: the rotation whose signs fit the rows best."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        signs = np.where(x @ rotation > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(x.T @ signs)
        rotation = u @ vt
    return rotation


def learn(x: np.ndarray, n: int, k: int, starts: int = 4, share: float = 0.97) -> CodeModel:
    """Fit on sampled vectors ``x`` of a table of ``n`` rows."""
    if not len(x):
        return CodeModel(np.zeros(1), np.zeros((1, 1)), 0)
    mean = x.mean(axis=0)
    rotation = np.concatenate([quantizing_rotation(x - mean, seed) for seed in range(starts)], axis=1)
    model = CodeModel(mean, rotation, 0)
    codes = model.codes(x)
    near = max(1, min(len(x) - 1, int(np.ceil(2 * k * len(x) / max(n, 1)))))
    distances = []
    for i in range(min(len(x), 512)):
        products = x @ x[i]
        products[i] = -np.inf
        best = np.argpartition(-products, min(near, len(x) - 1))[:near]
        distances.append(_ONES[codes[best] ^ codes[i]].sum(axis=1))
    model.radius = int(np.quantile(np.concatenate(distances), share)) if len(x) > 1 else rotation.shape[1]
    return model


def block_search(model: CodeModel, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """The best k of one block of rows for each query: (query, id, score)."""
    codes, asked = model.codes(x), model.codes(q)
    n_sub = codes.shape[1]
    reach = model.radius // n_sub
    index = [np.unique(codes[:, j], return_inverse=True) for j in range(n_sub)]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), 64):
        part = slice(at, min(at + 64, len(q)))
        met = np.zeros((part.stop - at, len(x)), bool)
        for j, (values, where) in enumerate(index):
            met |= (_ONES[values[None, :] ^ asked[part, j, None]] <= reach)[:, where]
        for i in range(part.stop - at):
            rows = np.flatnonzero(met[i])
            rows = rows[_ONES[codes[rows] ^ asked[at + i]].sum(axis=1) <= model.radius]
            rows = rows[ids[rows] != query_ids[at + i]]
            if len(rows) < k:
                rows = np.flatnonzero(ids != query_ids[at + i])
            score = x[rows] @ q[at + i]
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((np.full(len(best), query_ids[at + i]), ids[rows[best]], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def usable(vector_col: str) -> Column:
    """Whether a vector can take part (its dimension aside)."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 20, sample: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): the k largest inner products found."""
    ship(rows.sparkSession)
    clean = lambda df: (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & usable("v"))
        .distinct()
    )
    every, asked = clean(rows), clean(queries)
    sizes = every.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = (sizes["dim"], sizes["n"]) if sizes else (1, 0)
    every, asked = (df.where(F.size("v") == dim) for df in (every, asked))
    drawn = every.orderBy(F.xxhash64("id"), "id", "v").limit(sample).collect()  # bounded by ``sample``
    model = learn(np.array([r["v"] for r in drawn], np.float64).reshape(-1, dim), n, k)
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-asked.count() // QUERY_BLOCK))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = every.select(own(row_blocks).alias("rb"), numbers(query_blocks).alias("qb"), F.lit(False).alias("asks"), "id", "v")
    asking = asked.select(numbers(row_blocks).alias("rb"), own(query_blocks).alias("qb"), F.lit(True).alias("asks"), "id", "v")
    groups = dealt.unionByName(asking.select("rb", "qb", "asks", "id", "v"))
    groups = groups.repartition("rb", "qb").sortWithinPartitions("rb", "qb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 2):
            asks, ids = group.column("asks").to_numpy(), group.column("id").to_numpy()
            v = group.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
            if asks.any() and not asks.all():
                found = block_search(model, ids[~asks], v[~asks], ids[asks], v[asks], k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "id", "score"])

    found = groups.mapInArrow(run, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
    return ranked.select("query_id", "rank", "id", "score")
