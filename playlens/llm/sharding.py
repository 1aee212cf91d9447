"""Sharding by a Feistel permutation over global row numbers.

Every row gets a global row number 0..N-1; a keyed Feistel network with cycle
walking permutes these numbers, and the permuted number ``p`` gives
``shard = p mod n_shards`` and ``slot = p div n_shards``. The shuffle is
reproducible from the seed, shard sizes differ by one row at most (law
``rows``), slots are gapless from 0, and both directions are computable: the
shard and slot of a row number, and the row number at a shard and slot.

Row numbers without a global sort: rows are dealt to a fixed number of hash
buckets of their identity columns; a row's number is the count of all rows in
earlier buckets plus its place in its bucket. Equal rows are collapsed to one
row with a count first (a map-side partial aggregate), so a row repeated
through a third of the table is one row of every sort, and are expanded again
in bounded steps.

Everything is built from DataFrame functions; the only driver value is N.

Defined results: NULLs are ordinary values of the identity columns; rows equal
in all identity columns get consecutive numbers, one each; an empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6
#: Two primes just under 2**31 (fixed values of the round function).
P1, P2 = 2147483647, 2147483629
#: Walks until a number falls into range. The domain exceeds N by less than
#: its root, so a walk takes a second step with probability under 1/sqrt(N).
MAX_WALKS = 64
#: Buckets of the row numbering: the first three hex digits of an MD5.
BUCKETS = 16**3
#: A repeated row is expanded by steps of this many copies.
STEP = 10_000


def round_keys(seed: int) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, P1), rng.randrange(P1)) for _ in range(ROUNDS)]


def halves(n: int) -> tuple[int, int]:
    """The domain a * b >= n, near a square; both under 2**31."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    b = max(1, -(-n // a))
    if a >= 1 << 31:
        raise ValueError("too many rows for the round function")
    return a, b


def _round(x: str, key: tuple[int, int], modulus: int) -> str:
    """((x * k1 + k2) mod P1)**2 mod P2 mod modulus; no product reaches 2**63."""
    t = f"(({x}) * {key[0]}L + {key[1]}L) % {P1}L"
    return f"aggregate(array({t}), 0L, (acc, t) -> acc + t * t % {P2}L) % {modulus}L"


def _feistel(x: str, n: int, seed: int, inverse: bool = False) -> str:
    """One pass of the network over 0..a*b-1 as a SQL expression of ``x``.

    State (l, r) with l < a and r < b; even rounds add F(r) to l, odd rounds
    add F(l) to r. Lambda parameters hold the state, so the text stays short.
    """
    a, b = halves(n)
    steps = list(enumerate(round_keys(seed)))
    state = f"named_struct('l', ({x}) div {b}L, 'r', ({x}) % {b}L)"
    for i, key in reversed(steps) if inverse else steps:
        if i % 2 == 0:
            f = _round("s.r", key, a)
            moved = f"(s.l + {a}L - {f}) % {a}L" if inverse else f"(s.l + {f}) % {a}L"
            new = f"named_struct('l', {moved}, 'r', s.r)"
        else:
            f = _round("s.l", key, b)
            moved = f"(s.r + {b}L - {f}) % {b}L" if inverse else f"(s.r + {f}) % {b}L"
            new = f"named_struct('l', s.l, 'r', {moved})"
        state = f"transform(array({state}), s -> {new})[0]"
    return f"transform(array({state}), s -> s.l * {b}L + s.r)[0]"


def _walk(x: str, n: int, seed: int, inverse: bool) -> Column:
    """Apply the network until the number is below n (cycle walking)."""
    once = _feistel(x, n, seed, inverse)
    again = _feistel("v", n, seed, inverse)
    walked = f"aggregate(sequence(1, {MAX_WALKS}), {once}, (v, i) -> if(v < {n}L, v, {again}))"
    return F.expr(
        f"transform(array({walked}), w -> if(w < {n}L, w, CAST(raise_error('cycle walk too long') AS BIGINT)))[0]"
    )


def permuted(row_number: str, n: int, seed: int) -> Column:
    """The permuted number of a row-number column over 0..n-1."""
    return _walk(row_number, n, seed, inverse=False)


def unpermuted(number: str, n: int, seed: int) -> Column:
    """The row number whose permuted number is given."""
    return _walk(number, n, seed, inverse=True)


def row_number_at(shard: str, slot: str, n: int, n_shards: int, seed: int) -> Column:
    """The row number at a shard and slot."""
    return unpermuted(f"CAST({slot} AS BIGINT) * {n_shards}L + {shard}", n, seed)


def number_rows(df: DataFrame, identity: list[str]) -> DataFrame:
    """``identity`` columns plus ``row_number`` (0..N-1, no gaps)."""
    keyed = df.groupBy(*identity).agg(F.count(F.lit(1)).alias("_n"))
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in identity])
    keyed = keyed.withColumn("_bucket", F.substring(F.md5(text.cast("binary")), 1, 3))
    totals = keyed.groupBy("_bucket").agg(F.sum("_n").alias("_total"))  # at most BUCKETS rows
    totals = totals.select("_bucket", (F.sum("_total").over(Window.orderBy("_bucket")) - F.col("_total")).alias("_base"))
    in_order = Window.partitionBy("_bucket").orderBy(*identity)
    placed = keyed.withColumn("_before", F.sum("_n").over(in_order) - F.col("_n"))
    placed = placed.join(totals, "_bucket").withColumn("_first", F.col("_base") + F.col("_before"))
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / STEP).cast("long"))
    placed = placed.withColumn("_step", F.explode(steps))
    copies = F.sequence(
        F.col("_step") * STEP, F.least((F.col("_step") + 1) * STEP, F.col("_n")) - 1
    )
    placed = placed.withColumn("_copy", F.explode(copies))
    return placed.select(*identity, (F.col("_first") + F.col("_copy")).alias("row_number"))


def shard_rows(df: DataFrame, identity: list[str], n_shards: int, seed: int = 17) -> DataFrame:
    """``identity`` columns plus row_number, shard and slot of every row."""
    n = df.count()
    numbered = number_rows(df, identity)
    moved = numbered.withColumn("_p", permuted("row_number", n, seed))
    return moved.select(
        *identity,
        "row_number",
        (F.col("_p") % n_shards).cast("int").alias("shard"),
        F.expr(f"_p div {n_shards}").alias("slot"),
    )


def document_shards(
    docs: DataFrame, n_shards: int = 40, seed: int = 17, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    size: UTF-8 bytes of the text (NULL: none) plus 16. Law ``rows`` holds:
    shard counts differ by one at most; grown_shard is NULL.
    """
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    out = shard_rows(rows, ["id", "size", "text_crc32"], n_shards, seed)
    return out.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
