"""Byte-pair encoding and decoding by forced boundaries.

Method: a byte pair that occurs inside no token of the vocabulary marks a
certain cut, because no sequence of merges can produce a token across it. A
text is cut at such pairs (and where the word pattern always ends a piece),
the fragments are encoded independently by rank-ordered merges, and the ids
are concatenated. Equal fragments are encoded once per worker.

The result equals ``Tokenizer.encode(text, add_special_tokens=False).ids`` of
the ``tokenizers`` library for byte-level BPE files with the usual word
pattern, and ``decode`` equals its ``decode(ids, skip_special_tokens=False)``.

Defined results: a NULL text is encoded as the empty text (no ids); an empty
text has no ids and decodes to the empty text; texts of any length are encoded
whole; strings of special tokens inside a text become the special id, as in
the library; repeated rows give repeated results; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.batches import text_slices
from playlens.llm.common import ship
from playlens.llm.fragments import SEVERAL_WORDS, SINGLE_WORD, FragmentCache, split, splits_plainly
from playlens.llm.libtokens import byte_symbols, default_tokenizer
from playlens.llm.workercache import CACHE_BYTES, give_back, hold

#: The word pattern of byte-level BPE (a fixed value of the public format);
#: white space is the Unicode property, as in the library.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class ForcedBoundaryBpe:
    """Encoder and decoder for one byte-level BPE file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") is not None:
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        byte_of = {s: b for b, s in byte_symbols().items()}
        to_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        vocab = {to_bytes(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.id_of = vocab
        known = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.token_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.decimals = [b"%d" % i for i in range(len(self.token_bytes))]
        self.rank_of: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = (to_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank_of[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.never = len(self.merged)
        self.inside = token_pairs(vocab)
        self.first_id = [vocab.get(bytes([b])) for b in range(256)]
        self.words = regex.compile(WORD_PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.special_bytes = tuple(t.encode() for t in self.special)
        self.cache = FragmentCache(self._fragment)
        self.pieces = FragmentCache(self._piece, CACHE_BYTES // 2)

    # -- encoding -----------------------------------------------------------
    def encode(self, text: bytes) -> bytes:
        """Ids of a whole UTF-8 text as little-endian uint32 bytes."""
        if splits_plainly(text, self.special_bytes):
            return b"".join(map(self.cache.__getitem__, split(text)))
        whole, out, at = text.decode("utf-8"), [], 0
        for m in self.specials.finditer(whole) if self.specials else ():
            out += [self._words(whole[at : m.start()]), struct.pack("<I", self.special[m.group()])]
            at = m.end()
        return b"".join([*out, self._words(whole[at:])])

    def _words(self, text: str) -> bytes:
        return b"".join([self.pieces[w.encode()] for w in self.words.findall(text)])

    def _fragment(self, fragment: bytes) -> bytes:
        if SINGLE_WORD.fullmatch(fragment):
            return self._piece(fragment)
        if SEVERAL_WORDS.fullmatch(fragment):
            return b"".join([self.pieces[w] for w in SINGLE_WORD.findall(fragment)])
        return self._words(fragment.decode("utf-8"))

    def _piece(self, word: bytes) -> bytes:
        """One pre-token: cut at forced pairs, merge each part by rank."""
        ids, start, inside = [], 0, self.inside
        for i in range(1, len(word)):
            if not inside[word[i - 1]][word[i]]:
                ids += self._merge(word[start:i])
                start = i
        ids += self._merge(word[start:])
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge(self, part: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals, until no pair merges."""
        ids = [self.first_id[b] for b in part]
        if len(ids) > 64:
            return self._merge_long(ids)
        get, never, merged = self.rank_of.get, self.never, self.merged
        ranks = [get(pair, never) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < never:
            i = ranks.index(rank)
            ids[i : i + 2] = (merged[rank],)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), never)
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges with a heap over a linked list, n log n."""
        get, n = self.rank_of.get, len(ids)
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = [(rank, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (rank := get(pair)) is not None]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = right[i]
            if j >= 0 and (rank := get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i] if alive[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], right[i] = self.merged[rank], False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return [t for t, ok in zip(ids, alive) if ok]

    # -- decoding -----------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        """Token bytes joined and read as UTF-8; broken sequences become the
        replacement character and ids outside the vocabulary are skipped."""
        table = self.token_bytes
        try:
            return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
        except IndexError:
            return b"".join(table[i] for i in ids if 0 <= i < len(table)).decode("utf-8", "replace")


def token_pairs(vocab: dict[bytes, int]) -> list[list[bool]]:
    """``inside[a][b]``: whether byte b follows byte a inside some token."""
    inside = np.zeros((256, 256), dtype=bool)
    for token in vocab:
        raw = np.frombuffer(token, dtype=np.uint8)
        inside[raw[:-1], raw[1:]] = True
    return inside.tolist()


def forced_boundary_bpe(path: str) -> ForcedBoundaryBpe:
    """The worker's encoder for a tokenizer file."""
    return hold(("forced", path), lambda: ForcedBoundaryBpe(path))


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """(id, ids array<int>): the token ids of every whole text."""
    path = tokenizer or default_tokenizer()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = forced_boundary_bpe(path)
        for batch, texts in text_slices(batches, 1):
            coded = [bpe.encode(t) for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, ids)], ["id", "ids"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode_documents(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """(id, text): the text of every id list; a NULL list gives the empty text."""
    path = tokenizer or default_tokenizer()
    ship(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = forced_boundary_bpe(path)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    out = coded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return out.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def round_trip_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text: encode, decode
    the ids again and digest both, in one pass with no shuffle."""
    path = tokenizer or default_tokenizer()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = forced_boundary_bpe(path)
        for batch, texts in text_slices(batches, 1):
            counts, coded, decoded = [], [], []
            for text in texts:
                ids = np.frombuffer(bpe.encode(text), dtype="<u4").tolist()
                counts.append(len(ids))
                coded.append(hashlib.sha256(b",".join(map(bpe.decimals.__getitem__, ids))).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        give_back()

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return out.mapInArrow(run, schema).withColumnRenamed("id", id_col)
