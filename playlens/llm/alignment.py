"""Alignment of two tokenizers' tokens over the same text.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library and encodes
space + text; B is a ``sentencepiece`` model and encodes the text, to which it
adds the space itself. Both give byte spans over the same bytes.

1. **Spans.** A text is cut where no token of A or B can span (``certain_cuts``:
   A's word pattern ends there, and the byte pair is inside none of B's pieces).
   Texts that ``splits_plainly`` are cut together, by the pairs of bytes inside no token of
   either side, and each distinct fragment of a slice is looked up once. A fragment is encoded
   by the libraries while the worker's bounded cache doesn't hold it, together with the
   other new ones. Fragments whose joined bytes differ leave the text without tokens.
2. **Links.** Per batch, keyed by document, ``pandas.merge_asof`` finds for the
   start of each A token the B token that covers it, and for the start of each B
   token the covering A token. The union of both directions is every pair of
   overlapping tokens.
3. **Groups.** Offsets where tokens of both sides end cut them into groups.
4. **Counts.** A block (documents of about ``BLOCK_BYTES``) keeps its links as
   numbers into the block's own list of distinct id pairs. Only that list, with
   the number of documents of each pair, is summed over the corpus; the sums
   come back to the block by a join on the pair, so nothing is broadcast and no
   document's links are shuffled more than once.

Defined results: texts that are NULL, empty or not reproduced by both
tokenizers have zeros and an empty digest; rows with a NULL or repeated id are
aligned each by its own text and count as documents of their own; strings of
special tokens are plain text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.batches import text_slices
from playlens.llm.common import ship
from playlens.llm.fragments import byte_pairs, encode_fragments, single_words, splits_plainly
from playlens.llm.libtokens import WordModel, byte_symbols, default_tokenizer
from playlens.llm.workercache import BoundedCache, give_back, hold

#: Text of a block, whose links are kept as numbers into one list of pairs.
BLOCK_BYTES = 4 << 20
#: Bytes of a worker's cache of fragments.
FRAGMENT_BYTES = 40 << 20
_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: The space of sentencepiece pieces (a fixed value of the public format).
_SPACE = "▁"
#: What marks an id of side B, and a fragment that isn't reproduced.
_SIDE_B, _GONE = np.uint32(1 << 31), np.uint32(0xFFFFFFFF)
_LOST = _GONE.tobytes()


@lru_cache(maxsize=1)
def default_pieces() -> str:
    """The 32k sentencepiece model of the public tokenizers on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# -- spans ------------------------------------------------------------------
class TwoEncoders(BoundedCache):
    """fragment -> its A ids and then its B ids with ``_SIDE_B`` added, as
    little-endian uint32; ``_LOST`` where the joined bytes of either side
    differ from the fragment."""

    def __init__(self, path_a: str, path_b: str):
        super().__init__(FRAGMENT_BYTES)
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {s: b for b, s in byte_symbols().items()}
        vocab = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.cut = certain_cuts(self.bytes_b)
        self.words = WordModel(self.a.model)
        self.inside_b = byte_pairs(self.bytes_b)
        end = self.b.encode("x ")[len(self.b.encode("x")) :]
        self.line = self.b.encode("\n")
        self.trailing = end if b"".join(map(self.bytes_b.__getitem__, end)) == b" " else None
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [b"%d%c" % (i, sep) for sep in b",|;" for i in range(n)]
        self.n = n

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace(_SPACE, " ").encode()

    def _together(self, fragments: list[bytes]) -> list[bytes]:
        """The values of new fragments, few calls of the libraries for all."""
        texts = [f.decode("utf-8", "replace") for f in fragments]
        words = single_words(fragments)
        a = dict(zip(words, self.words.ids(words)))
        a = [a[f] if f in a else _packed(self.a.encode(t, add_special_tokens=False).ids) for f, t in zip(fragments, texts)]
        # B adds a space to a text, so a fragment without goes behind a sign that no piece joins to it
        b = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        n = len(self.line)
        for k, t in enumerate(texts):
            if t[0] != " " and b[k][:n] == self.line:
                b[k] = b[k][n:]
            elif t[0] != " " or t == " ":
                b[k] = self._b(t)
        counts, flat = np.array([len(x) for x in b]), np.fromiter(chain.from_iterable(b), "<u4")
        lost = [
            x != f or y != f
            for f, x, y in zip(fragments, self._joined(b"".join(a), [len(x) // 4 for x in a], self.bytes_a), self._joined(flat, counts, self.bytes_b))
        ]
        coded, ends = (flat | _SIDE_B).tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
        return [_LOST if gone else x + coded[i:j] for gone, x, i, j in zip(lost, a, ends, ends[1:])]

    @staticmethod
    def _joined(ids: bytes | np.ndarray, counts: list[int] | np.ndarray, table: list[bytes]) -> list[bytes]:
        """The bytes that each fragment's ids (``counts`` of them) stand for."""
        raw = [table[i] for i in np.frombuffer(ids, "<u4").tolist()]
        ends = [0, *np.cumsum(counts).tolist()]
        return [b"".join(raw[i:j]) for i, j in zip(ends, ends[1:])]

    def _b(self, text: str) -> list[int]:
        """B's ids of a fragment; the model adds a space to a text, so one that
        starts without is encoded behind a sign that no piece joins to it."""
        if text[0] == " ":
            return self.trailing if text == " " and self.trailing else self.b.encode(text[1:])
        ids = self.b.encode("\n" + text)
        return ids[len(self.line) :] if ids[: len(self.line)] == self.line else self.b.encode(text)

    def encode(self, text: bytes) -> tuple[bytes, bytes] | None:
        """Ids of both sides, None for a text without tokens."""
        ids, _ = self.encode_all([text])
        return tuple(part.astype("<u4").tobytes() for part, _ in ids) if len(ids[0][0]) else None

    def encode_all(self, texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """((ids, their texts' numbers) of side A, the same of side B) and
        which texts have tokens."""
        spaced = [b" " + t if t else b"" for t in texts]
        plain = [splits_plainly(t) for t in spaced]
        ready = list(compress(spaced, plain))
        coded = iter(encode_fragments(ready, self, self._together, self.words.inside, self.inside_b) if ready else [])
        parts = [None if p else self.cut.split(t) for t, p in zip(spaced, plain)]
        rest = list(set(chain.from_iterable(x for x in parts if x)) - {b""})
        value = dict(zip(rest, self.values_of(rest, self._together))) | {b"": b""}
        coded = [next(coded) if x is None else b"".join(map(value.__getitem__, x)) for x in parts]
        ids = np.frombuffer(b"".join(coded), "<u4")
        doc = np.repeat(np.arange(len(texts)), [len(c) // 4 for c in coded])
        has = np.array([len(c) > 0 for c in coded], bool)
        has[doc[ids == _GONE]] = False
        if not has.all():
            ids, doc = ids[has[doc]], doc[has[doc]]
        side_b = ids >= _SIDE_B
        return [(ids[~side_b].astype(np.int64), doc[~side_b]), ((ids[side_b] - _SIDE_B).astype(np.int64), doc[side_b])], has


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def certain_cuts(pieces: list[bytes]) -> re.Pattern:
    """Places that no token of either side spans. A's word pattern ends a piece
    between a printable character and a space or line feed, between a letter or
    digit and a mark, and behind a line feed between two printable characters; B's merges can't cross a byte pair that is inside no
    piece, so the following bytes that no piece holds behind any of the others are taken."""
    inside = {(x, y) for raw in pieces for x, y in zip(raw, raw[1:])}
    places = []
    for follows, before in ((b" \n", _ALNUM + _MARKS), (_MARKS, _ALNUM)):
        free = bytes(y for y in follows if not any((x, y) in inside for x in before))
        if free:
            places.append(b"(?<=[" + re.escape(before) + b"])(?=[" + re.escape(free) + b"])")
    if not any((10, x) in inside for x in _ALNUM + _MARKS):  # behind a single line feed
        places.append(rb"(?<=[!-~]\n)(?=[!-~])")
    return re.compile(b"|".join(places)) if places else re.compile(b"(?!)")


# -- alignment of a batch ---------------------------------------------------
def spans(ids: np.ndarray, doc: np.ndarray, sizes: np.ndarray, bases: np.ndarray):
    """A frame of the tokens of all documents: doc, id, start and end, with
    positions that go on from one document to the next."""
    import pandas as pd

    width = sizes[ids]
    ends = np.cumsum(width)
    before = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(len(bases)))]
    ends = ends + (bases - before)[doc]
    return pd.DataFrame({"doc": doc, "id": ids, "start": ends - width, "end": ends, "at": np.arange(len(ids))})


def overlaps(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` of every overlapping pair of tokens."""
    import pandas as pd

    covering_b = pd.merge_asof(a[["doc", "start", "at"]], b[["doc", "start", "at"]], on="start", by="doc", suffixes=("_a", "_b"))
    covering_a = pd.merge_asof(b[["doc", "start", "at"]], a[["doc", "start", "at"]], on="start", by="doc", suffixes=("_b", "_a"))
    i, j = covering_b["at_a"].to_numpy(), covering_b["at_b"].to_numpy(np.int64)
    k, m = covering_a["at_a"].to_numpy(np.int64), covering_a["at_b"].to_numpy()
    other = a["start"].to_numpy()[k] != b["start"].to_numpy()[m]  # equal starts are found in both directions
    return np.concatenate([i, k[other]]), np.concatenate([j, m[other]])


def group_texts(a, b, n_docs: int, encoders: TwoEncoders) -> tuple[np.ndarray, list[bytes]]:
    """The number of groups of every document and their written form."""
    ends_a, ends_b = a["end"].to_numpy(), b["end"].to_numpy()
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    side = np.concatenate([np.searchsorted(cuts, ends_a) * 2, np.searchsorted(cuts, ends_b) * 2 + 1])
    order = np.argsort(side, kind="stable")
    side, doc = side[order], np.concatenate([a["doc"], b["doc"]])[order]
    last = np.concatenate([side[1:] != side[:-1], np.ones(min(1, len(side)), bool)])
    separator = np.where(last, 1 + side % 2, 0)
    written = (np.concatenate([a["id"], b["id"]])[order] + separator * encoders.n).tolist()
    bounds = np.searchsorted(doc, np.arange(n_docs + 1)).tolist()
    texts = [b"".join(map(encoders.written.__getitem__, written[i:j]))[:-1] for i, j in zip(bounds, bounds[1:])]
    n_groups = np.bincount(doc[last & (side % 2 == 1)], minlength=n_docs)
    return n_groups, texts


def align(texts: list[bytes], encoders: TwoEncoders) -> dict[str, list | np.ndarray]:
    """The columns of a batch of texts, and the id pairs of its links in
    document order (``pairs``, A id in the upper half)."""
    sides, _ = encoders.encode_all(texts)
    bases = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])[:-1]]).astype(np.int64)
    a, b = (spans(*side, sizes, bases) for side, sizes in zip(sides, (encoders.size_a, encoders.size_b)))
    i, j = overlaps(a, b)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    n_groups, written = group_texts(a, b, len(texts), encoders)
    doc = a["doc"].to_numpy()[i]
    return {
        "n_a": np.bincount(a["doc"], minlength=len(texts)),
        "n_b": np.bincount(b["doc"], minlength=len(texts)),
        "n_groups": n_groups,
        "n_links": np.bincount(doc, minlength=len(texts)),
        "groups_sha256": [hashlib.sha256(w).hexdigest() if w else "" for w in written],
        "groups": written,
        "pairs": a["id"].to_numpy()[i] << 32 | b["id"].to_numpy()[j],
    }


# -- the corpus -------------------------------------------------------------
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ALIGNED = "block long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs array<long>, docs array<long>"
_KINDS = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]


def _two_encoders(path_a: str, path_b: str) -> TwoEncoders:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return hold(("two", path_a, path_b), lambda: TwoEncoders(path_a, path_b))


def aligned_blocks(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (with their links as numbers) and one row a block
    with its distinct pairs and their numbers of documents."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoders = _two_encoders(path_a, path_b)
        first, held, size, k = TaskContext.get().partitionId() << 32, [], 0, 0
        for part, texts in text_slices(batches, 1):
            held.append((part.column(0), align(texts, encoders)))
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield from block_rows(first + k, held)
                held, size, k = [], 0, k + 1
        if held:
            yield from block_rows(first + k, held)
        give_back()

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, _ALIGNED)


def block_rows(block: int, held: list[tuple[pa.Array, dict]]) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    links = np.concatenate([h[1]["n_links"] for h in held])
    pairs, slots = np.unique(np.concatenate([h[1]["pairs"] for h in held]), return_inverse=True)
    doc = np.repeat(np.arange(len(links)), links)
    once = np.unique(doc * max(1, len(pairs)) + slots) % max(1, len(pairs))
    docs = np.bincount(once, minlength=len(pairs))
    slots = slots.astype("<u4")
    at = 0
    for ids, found in held:
        n = len(ids)
        ends = at + np.cumsum(found["n_links"])
        coded = [squeeze(slots[e - c : e].tobytes()) for e, c in zip(ends.tolist(), found["n_links"].tolist())]
        at = int(ends[-1])
        columns = [np.full(n, block), ids, *[found[c] for c in _COUNTS], found["groups_sha256"], coded, [None] * n, [None] * n]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, _KINDS)], _NAMES)
    columns = [[block], [None], *[[None]] * 6, [pairs], [docs]]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], _NAMES)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): the documents that hold each linked id pair, and
    whether no pair of its A id is held by more."""
    rows = blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    counts = materialize(counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_a: str | None = None,
    tokenizer_b: str | None = None,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    blocks = materialize(aligned_blocks(docs, id_col, text_col, tokenizer_a or default_tokenizer(), tokenizer_b or default_pieces()), "aligned")
    slots = blocks.where("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("slot", "pair"))
    answers = slots.join(pair_counts(blocks), "pair").select("block", "slot", "count", "best")
    rows = blocks.where("pairs IS NULL").select("block", "id", *_COUNTS, "groups_sha256", "links")
    both = answers.unionByName(rows, allowMissingColumns=True)
    # a block's answers come before its documents
    dealt = both.repartition("block").sortWithinPartitions("block", F.col("slot").asc_nulls_last())
    out_names = ["id", *_COUNTS, "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        state = {"block": None, "count": [], "best": []}
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for i, j in zip(cuts, cuts[1:]):
                part = batch.slice(i, j - i)
                if state["block"] != block[i]:
                    state = {"block": block[i], "count": [], "best": []}
                split = len(part) - part.column("slot").null_count
                if split:
                    state["count"].append(part.column("count").slice(0, split).to_numpy())
                    state["best"].append(part.column("best").slice(0, split).to_numpy(zero_copy_only=False))
                if split == len(part):
                    continue
                if len(state["count"]) > 1:
                    state["count"], state["best"] = [np.concatenate(state["count"])], [np.concatenate(state["best"])]
                rest = part.slice(split)
                n_best, total = [], []
                for coded in rest.column("links").to_pylist():
                    own = np.frombuffer(expand(coded), "<u4")
                    n_best.append(int(state["best"][0][own].sum()) if len(own) else 0)
                    total.append(int(state["count"][0][own].sum()) if len(own) else 0)
                columns = [rest.column(c) for c in ["id", *_COUNTS]]
                columns += [pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), rest.column("groups_sha256")]
                yield pa.RecordBatch.from_arrays(columns, out_names)

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)
