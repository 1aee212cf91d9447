"""Best-fit packing by linear grouping.

Documents are packed into sequences of ``capacity`` tokens. Only documents
longer than a sequence are cut: into full sequences, the first piece taking
the remainder. What is left to pack is one piece of 1..capacity-1 tokens per
document, and everything the plan needs to know about them is how many have
each length: a histogram of at most ``capacity`` rows, whatever the corpus.

The plan (driver, on the histogram, in runs of equal bins):

1. lengths over ``capacity / small_share`` are large. Sorted downwards they
   are cut into ``groups`` groups of equal cardinality, and every length is
   rounded up to the largest of its group, which leaves few distinct sizes;
2. the cutting-stock LP over those few sizes is solved by column generation
   (a knapsack per new configuration); configurations are used the rounded
   down number of times, and what remains is packed by fullest-bin search
   over the same sizes;
3. actual documents take the places of the rounded sizes, largest first;
4. small lengths, largest first, go into the bin that they fill best.

How many groups and which lengths count as large are tried in several pairs
(``SCHEMES``) on the histogram, and the plan with the fewest bins is kept: few
large sizes suit configurations of two or three pieces with hardly any
rounding, more sizes suit configurations of up to six. At a share of 2 no two
large pieces fit together, so that scheme alone is best-fit decreasing, and the
kept plan is never worse than it.

Placing is distributed: the plan is a table of runs (length, first rank, how
many, first sequence, offset), and each piece finds its run by its rank among
the pieces of its length. Ranks come from counts per (length, bucket) and a
window inside each bucket, so a length shared by a third of all pieces is
split over all buckets; the most frequent length sets their number.

Defined results: a NULL or empty text has only the end id (one token); a NULL
id is kept; repeated rows are separate documents; an empty table packs into
nothing. Which of several equally long pieces takes which place is decided by
a row number fixed when the pieces are written.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.batches import text_slices
from playlens.llm.common import ship
from playlens.llm.libtokens import ENCODED_BYTES, ENCODED_ROWS, default_tokenizer, library_encoder
from playlens.llm.workercache import give_back

#: Fewest buckets of the ranks of equally long pieces, and pieces of a bucket.
RANK_BUCKETS, BUCKET_PIECES = 256, 1 << 17
#: (groups, small share) of the plans that are compared.
SCHEMES = ((340, 3), (120, 6), (1, 2))
#: Runs of a plan up to which it is broadcast (40 bytes each).
BROADCAST_RUNS = 200_000


# -- pieces -----------------------------------------------------------------
def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] * (n > 0) + [(at, capacity) for at in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame,
    capacity: int = 1024,
    end_id: int = 2,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's pieces."""
    path = tokenizer or default_tokenizer()
    ship(docs.sparkSession)
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = library_encoder(path), struct.pack("<I", end_id)
        for batch, texts in text_slices(batches, 1, ENCODED_BYTES, ENCODED_ROWS):
            columns = [[] for _ in names]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(texts)):
                ids += end
                for piece, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(columns, (doc_id, piece, start, length, zlib.crc32(own), own)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        give_back()

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return out.mapInArrow(run, schema)


# -- the plan ---------------------------------------------------------------
@dataclass
class Bins:
    """``count`` bins alike: for each item (length, rank in the first bin)."""

    count: int
    items: list[tuple[int, int]] = field(default_factory=list)

    def used(self) -> int:
        return sum(length for length, _ in self.items)

    def split(self, first: int) -> tuple[Bins, Bins]:
        rest = [(length, rank + first) for length, rank in self.items]
        return Bins(first, list(self.items)), Bins(self.count - first, rest)


def group_sizes(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal cardinality, largest lengths first: (rounded size,
    [(length, how many)]); neighbours with one rounded size are joined."""
    total = sum(counts.values())
    each = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                room = each
                if not out or out[-1][0] != length:
                    out.append((length, []))
            take = min(room, left)
            out[-1][1].append((length, take))
            left, room = left - take, room - take
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 3000) -> list[tuple[np.ndarray, int]]:
    """(configuration, times) meeting ``demand`` exactly: the cutting-stock LP
    by column generation, rounded down, then fullest bins for the rest."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    use = demand / np.diag(basis)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(m))
        value, column = knapsack(sizes, price, capacity)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        ratios = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        use = np.maximum(use - ratios[out] * step, 0)
        basis[:, out], use[out] = column, ratios[out]
    left, plan = demand.astype(np.int64).copy(), []
    for k in np.argsort(-use, kind="stable"):
        column = np.rint(basis[:, k]).astype(np.int64)
        times = int(use[k] + 1e-6)
        needed = column > 0
        times = min([times, *(left[needed] // column[needed]).tolist()])
        if times > 0:
            plan.append((column, times))
            left -= times * column
    while left.any():
        column = fullest_bin(sizes, left, capacity)
        needed = column > 0
        times = int((left[needed] // column[needed]).min())
        plan.append((column, times))
        left -= times * column
    return plan


def knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: best value and how many of each size.

    Layer t holds the best value of at most t sizes for every room; all sizes
    are large, so there are few layers.
    """
    m, layers = len(sizes), int(capacity // sizes.min())
    column = np.zeros(m)
    if layers <= 2:  # one size, or the best pair that fits
        pair = np.where(sizes[:, None] + sizes[None, :] <= capacity, price[:, None] + price[None, :], -np.inf)
        i, j = divmod(int(np.argmax(pair)), m)
        k = int(np.argmax(price))
        chosen = [i, j] if pair[i, j] > price[k] else [k]
    else:
        best, picks = np.zeros(capacity + 1), []
        for _ in range(layers):
            layer, pick = best.copy(), np.full(capacity + 1, -1)
            for k in np.argsort(sizes):
                value = best[: capacity + 1 - sizes[k]] + price[k]
                better = value > layer[sizes[k] :] + 1e-12
                layer[sizes[k] :][better], pick[sizes[k] :][better] = value[better], k
            best = layer
            picks.append(pick)
        chosen, room = [], capacity
        for pick in reversed(picks):
            if pick[room] >= 0:
                chosen.append(int(pick[room]))
                room -= int(sizes[chosen[-1]])
    np.add.at(column, chosen, 1)
    return float(price @ column), column


def fullest_bin(sizes: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """A configuration with the largest size left, filled as far as the counts
    allow (subset sums over the sizes, larger sizes first)."""
    column = np.zeros(len(sizes), dtype=np.int64)
    seed = int(np.flatnonzero(left)[np.argmax(sizes[left > 0])])
    column[seed] = 1
    room, avail = int(capacity - sizes[seed]), left.copy()
    avail[seed] -= 1
    reach: dict[int, tuple[int, int]] = {0: (-1, 0)}  # sum -> (last size, sum before)
    for k in np.argsort(-sizes, kind="stable"):
        if not avail[k] or sizes[k] > room:
            continue
        layer = list(reach)
        for base in layer:
            at = base
            for _ in range(int(min(avail[k], (room - base) // sizes[k]))):
                before, at = at, at + int(sizes[k])
                if at in reach:
                    break
                reach[at] = (int(k), before)
        if room in reach:
            break
    at = max(reach)
    while at:
        k, at = reach[at]
        column[k] += 1
    return column


def plan_bins(counts: dict[int, int], capacity: int, schemes: Sequence[tuple[int, int]] = SCHEMES) -> list[Bins]:
    """Bins for ``counts`` (length -> how many); ranks number the pieces of a
    length from 0, each used once. Of the plans of all ``schemes`` (groups,
    small share) the first with the fewest bins."""
    plans = [plan_scheme(counts, capacity, *scheme) for scheme in schemes]
    return min(plans, key=lambda bins: sum(b.count for b in bins))


def plan_scheme(counts: dict[int, int], capacity: int, groups: int, small_share: int) -> list[Bins]:
    """The plan with lengths over ``capacity / small_share`` in ``groups`` groups."""
    bins = [Bins(counts[capacity], [(capacity, 0)])] if counts.get(capacity) else []
    large = {k: n for k, n in counts.items() if capacity // small_share < k < capacity and n}
    small = {k: n for k, n in counts.items() if 0 < k <= capacity // small_share and n}
    room: dict[int, list[Bins]] = defaultdict(list)
    if large:
        grouped = group_sizes(large, groups)
        sizes = np.array([size for size, _ in grouped], dtype=np.int64)
        demand = np.array([sum(n for _, n in runs) for _, runs in grouped], dtype=np.int64)
        ranks = {}  # next unused rank of each length, in group order
        queues = []
        for _, runs in grouped:
            queue = []
            for length, n in runs:
                queue.append([length, ranks.get(length, 0), n])
                ranks[length] = ranks.get(length, 0) + n
            queues.append(queue)
        for column, times in configurations(sizes, demand, capacity):
            for filled in substitute(column, times, queues):
                room[capacity - filled.used()].append(filled)
    for length in sorted(small, reverse=True):
        place_small(length, small[length], room, capacity)
    return bins + [b for r in sorted(room) for b in room[r]]


def substitute(column: np.ndarray, times: int, queues: list[list[list[int]]]) -> list[Bins]:
    """``times`` bins of one configuration, their places taken by actual
    lengths in the order of each group's queue; alike bins stay one entry."""
    places = []
    for k in np.flatnonzero(column):
        for _ in range(int(column[k])):
            runs, need = [], times
            while need:
                head = queues[k][0]
                take = min(need, head[2])
                runs.append((head[0], head[1], take))
                head[1], head[2], need = head[1] + take, head[2] - take, need - take
                if not head[2]:
                    queues[k].pop(0)
            places.append(runs)
    cuts = sorted({0, times, *(c for runs in places for c in np.cumsum([n for _, _, n in runs]).tolist())})
    out, state = [], [[0, 0] for _ in places]  # run and used part of it, per place
    for a, b in zip(cuts, cuts[1:]):
        items = []
        for runs, at in zip(places, state):
            length, rank, n = runs[at[0]]
            items.append((length, rank + at[1]))
            at[1] += b - a
            if at[1] == n:
                at[0], at[1] = at[0] + 1, 0
        out.append(Bins(b - a, items))
    return out


def place_small(length: int, n: int, room: dict[int, list[Bins]], capacity: int) -> None:
    """Best fit: each piece into the bin with the least room that holds it."""
    rank = 0
    while rank < n:
        fits = [r for r in room if r >= length and room[r]]
        if not fits:
            each = capacity // length
            whole, part = divmod(n - rank, each)
            if whole:
                room[capacity - each * length].append(Bins(whole, [(length, rank + i * whole) for i in range(each)]))
            if part:
                room[capacity - part * length].append(Bins(1, [(length, rank + each * whole + i) for i in range(part)]))
            return
        best = min(fits)
        found = room[best].pop()
        if found.count > n - rank:
            found, rest = found.split(n - rank)
            room[best].append(rest)
        found.items.append((length, rank))
        room[best - length].append(found)
        rank += found.count


def plan_rows(bins: list[Bins]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, how many, first sequence, offset) of every run."""
    rows, sequence = [], 0
    for b in bins:
        offset = 0
        for length, rank in b.items:
            rows.append((length, rank, b.count, sequence, offset))
            offset += length
        sequence += b.count
    return rows


# -- placing ----------------------------------------------------------------
def with_rank(pieces: DataFrame, length_col: str = "length", row_col: str = "_row", buckets: int = RANK_BUCKETS) -> DataFrame:
    """``pieces`` plus ``_rank``, 0.. among the pieces of one length."""
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(row_col), F.lit(buckets)))
    counts = dealt.groupBy(length_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy(length_col).orderBy("_bucket")  # at most ``buckets`` rows a length
    bases = counts.select(length_col, "_bucket", (F.sum("_n").over(in_order) - F.col("_n")).alias("_base"))
    inside = Window.partitionBy(length_col, "_bucket").orderBy(row_col)
    ranked = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        ranked.join(bases, [length_col, "_bucket"])
        .withColumn("_rank", F.col("_base") + F.col("_place"))
        .drop("_bucket", "_base", "_place")
    )


def pack(pieces: DataFrame, capacity: int = 1024, schemes: Sequence[tuple[int, int]] = SCHEMES) -> DataFrame:
    """``pieces`` (with ``length``) plus sequence_id and offset."""
    spark = pieces.sparkSession
    stored = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    # At most ``capacity`` rows reach the driver.
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan_rows(plan_bins(counts, capacity, schemes))
    schema = "_len long, _lo long, _count long, _sequence long, _offset long"
    plan = spark.createDataFrame(runs, schema)
    ranked = with_rank(stored, buckets=max(RANK_BUCKETS, -(-max(counts.values(), default=0) // BUCKET_PIECES)))
    # The plan's rows follow the distinct lengths and configurations, not the corpus.
    placed = ranked.join(
        F.broadcast(plan) if len(runs) <= BROADCAST_RUNS else plan,
        (F.col("length") == F.col("_len"))
        & (F.col("_rank") >= F.col("_lo"))
        & (F.col("_rank") < F.col("_lo") + F.col("_count")),
    )
    return placed.select(
        *[c for c in pieces.columns],
        (F.col("_sequence") + F.col("_rank") - F.col("_lo")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    capacity: int = 1024,
    end_id: int = 2,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset);
    ``with_ids`` keeps the token ids of every piece (little-endian uint32)."""
    pieces = token_pieces(docs, capacity, end_id, tokenizer, id_col, text_col, with_ids)
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
