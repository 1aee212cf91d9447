"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes of ``bits`` bits (at most 64) are cut into ``m`` segments and every
segment has an index. For a query, segment after segment is searched with a
growing radius: once the first ``a`` segments have been probed to radius r and
the others to r - 1, every code within distance ``m * r + a - 1`` has been
met (pigeonhole), so a query is finished as soon as its k-th verified distance
is within that bound. In round r a query probes only the segments it still
needs for that proof. The result is exact.

``m`` follows the size of the index: segments of about log2(n) - 5 bits, so a
probe meets about 32 codes, whose distances are compared inside the join, and
a full enumeration of a segment has fewer probes than the index has rows. Rows with equal codes collapse to one entry with their k + 1
smallest ids (more can never be among the results), so a code held by a third
of all rows is one entry. Equal query codes are searched once.

Defined results: rows with a NULL id or code take no part; the query's own id
is not among its results; ties go to the smaller id; a row repeated under one
id counts once; with fewer than k other rows all are returned; an empty table
or no queries give an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.common import ship


def sign_code(vector_col: str, bits: int = 64) -> Column:
    """Bit i is set where component i is positive; NULL for vectors that are
    NULL, of another length, or hold NULL or non-finite components."""
    v = F.col(vector_col)
    usable = (F.size(v) == bits) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    code = F.expr(
        f"aggregate(sequence(0, {bits - 1}), 0L, (acc, i) -> acc | "
        f"if(element_at(`{vector_col}`, i + 1) > 0, shiftleft(1L, i), 0L))"
    )
    return F.when(v.isNotNull() & usable, code)


def segments(bits: int, n: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments for an index of n codes."""
    m = max(1, min(bits // 4, round(bits / max(4.0, math.log2(max(n, 2)) - 5))))
    cuts = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def flips(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with exactly ``radius`` set."""
    return np.array([sum(1 << i for i in c) for c in itertools.combinations(range(width), radius)], np.int64)


def hamming_top_k(
    rows: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64, id_col: str = "id", code_col: str = "code"
) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest rows of every query."""
    spark = rows.sparkSession
    ship(spark)
    clean = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(code_col).cast("long").alias("code")).dropna()
    asked = materialize(clean(queries).distinct(), "hamming-queries")
    nearest_ids = Window.partitionBy("code").orderBy("id")
    kept = clean(rows).distinct().withColumn("_r", F.row_number().over(nearest_ids)).where(f"_r <= {k + 1}")
    index = materialize(kept.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "hamming-index")
    parts = segments(bits, index.count())
    m = len(parts)
    cut = [F.struct(F.lit(j).alias("seg"), F.expr(f"shiftrightunsigned(code, {a}) & {(1 << w) - 1}L").alias("value")) for j, (a, w) in enumerate(parts)]
    postings = index.select("code", F.explode(F.array(*cut)).alias("at")).select("code", "at.seg", "at.value")

    # state: one row per query code; bound is its k-th verified distance so far
    state = asked.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(bits))
    found: DataFrame | None = None
    radius = 0
    while True:
        probes = _probes(state, parts, radius)
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int")
        # Merged: the planner can't know how many probes a query makes and would broadcast them.
        hits = probes.hint("merge").join(postings, ["seg", "value"]).where(distance <= F.col("bound")).select("q", "code", distance.alias("distance"))
        found = hits.distinct() if found is None else found.unionByName(hits).distinct()
        found, bounds = _tightened(found, index, k, bits)
        # Every code within m * (radius + 1) - 1 has been met by a query that probed all segments,
        # and a query that probed fewer had its bound covered by them.
        state = state.select("q").join(bounds, "q", "left").select("q", F.coalesce("bound", F.lit(bits)).alias("bound"))
        state = materialize(state.where(F.col("bound") > m * (radius + 1) - 1), "hamming-state")
        radius += 1
        if m * radius - 1 >= bits or state.isEmpty():
            break

    answers = found.join(index, "code").select("q", "distance", F.explode("ids").alias("id"))
    mine = asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(answers, "q").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = mine.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
    return ranked.select("query_id", "rank", "id", "distance")


def _probes(state: DataFrame, parts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(q, bound, seg, value): the values at exactly ``radius`` flips in the
    segments that a query needs to cover its bound."""
    m = len(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [flips(w, radius) for _, w in parts]
        for batch in batches:
            for q, bound in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for j, (first, width) in enumerate(parts[: max(1, min(m, bound - m * radius + 1))]):
                    values = masks[j] ^ ((q & (1 << 64) - 1) >> first & (1 << width) - 1)
                    if len(values):
                        n = len(values)
                        columns = [np.full(n, q), np.full(n, bound, np.int32), np.full(n, j, np.int32), values]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "bound", "seg", "value"])

    return state.select("q", "bound").mapInArrow(run, "q long, bound int, seg int, value long")


def _tightened(found: DataFrame, index: DataFrame, k: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The verified candidates within each query's new bound, and the bounds:
    the distance at which k + 1 rows (the query may be one) are reached."""
    counted = found.join(index.select("code", F.size("ids").alias("n")), "code")
    by_distance = counted.groupBy("q", "distance").agg(F.sum("n").alias("n"))  # at most bits + 1 rows a query
    order = Window.partitionBy("q").orderBy("distance")
    reached = by_distance.withColumn("_c", F.sum("n").over(order)).where(f"_c >= {k + 1}")
    bounds = reached.groupBy("q").agg(F.min("distance").cast("int").alias("bound"))
    bounds = materialize(bounds, "hamming-bounds")
    kept = found.join(bounds, "q", "left").where(F.col("distance") <= F.coalesce("bound", F.lit(bits)))
    return materialize(kept.select("q", "code", "distance"), "hamming-found"), bounds
