"""Language identification by nearest centroids.

A text becomes counts of its byte bigrams and trigrams (lower-cased; runs
without letters act as blanks) hashed to ``DIM`` buckets, damped, weighted by
inverse document frequency and scaled to length 1. Every language has several
centroids, found by spherical k-means over its own documents, because one
language holds several kinds of text. A document gets the language of the
centroid with the highest cosine, and is *rejected* when even that cosine is
under the floor of its language and its size.

A text's size is the number of its distinct n-gram buckets, in powers of two: the
fewer a text has, the lower its cosine may be. The floors are learned from the
training documents and their beginnings of 12, 24, ... characters, each
measured against centroids that were found without it (on the half of its
language's sample it is not in). A floor is ``MARGIN`` of the cosine that all
but one in a hundred of a language and size reach, so that clean documents stay
well above it. Unseen languages of the same script share n-grams with the known
ones; under some 64 buckets (about 60 characters) they are not told apart reliably.

Document frequencies are counted over all learnable documents; the centroids
are fitted on at most ``per_language`` documents of each language (the ones
with the smallest hash of their id and text; rows that repeat both count once), which
is the documented bound of the sample. The model is a few hundred KB whatever the corpus.

Defined results: a NULL text or a text without a letter is ``und`` with score
0 and is rejected; a NULL id belongs to no fold and is held in (it is learned
from when it has a language); ties between languages go to the first in
alphabetical order; without any learnable document every text is ``und``; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.config import materialize
from playlens.llm.common import ship
from playlens.llm.workercache import hold, release

DIM = 4096
UNDETERMINED = "und"
#: Sizes of a text (log2 of its distinct n-gram buckets), and what a floor needs and leaves.
SIZES, LEAST, MARGIN = DIM.bit_length(), 20, 0.6
#: Word characters that may be letters; ``has_letter`` asks each kind found.
_MAYBE = re.compile(r"[^\W\d_]+")
#: ASCII letters and all bytes of multi-byte characters stay, the rest is blank.
_KEEP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether a text has a letter (Unicode category L; superscripts,
    fractions and letter-like numerals are none)."""
    return any(any(map(str.isalpha, set(m.group()))) for m in _MAYBE.finditer(text))


def ngram_counts(texts: list[str]) -> np.ndarray:
    """Hashed bigram and trigram counts, one row of DIM per text."""
    hold("language")
    parts = [b" " + t.lower().encode().translate(_KEEP) + b"  " for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    two = (raw[:-2] << 8) | raw[1:-1]
    three = (two << 8) | raw[2:]
    shift = np.uint32(32 - (DIM.bit_length() - 1))
    blank = raw == 32
    out = np.zeros(len(parts) * DIM)
    for code, factor, use in (
        (two, 0x9E3779B1, ~(blank[:-2] & blank[1:-1])),
        (three, 0x85EBCA6B, ~(blank[1:-1] & (blank[:-2] | blank[2:]))),
    ):
        bucket = ((code + np.uint32(1)) * np.uint32(factor)) >> shift
        out += np.bincount((row[:-2] * DIM + bucket)[use], minlength=len(out))
    return out.reshape(-1, DIM)


def sizes(counts: np.ndarray) -> np.ndarray:
    """log2 of the number of buckets that a text fills, rounded down."""
    return np.frexp(np.maximum((counts > 0).sum(axis=1), 1))[1] - 1


def beginnings(text: str) -> list[str]:
    """The first 12, 24, ... 3,072 characters where they have a letter, and the text."""
    cuts = [text[: 12 << k] for k in range(9) if 12 << k < len(text)]
    return [c for c in cuts if has_letter(c)] + [text]


def blocks(texts: list[str], target: int = 1 << 18) -> Iterator[list[str]]:
    """Runs of texts of about ``target`` characters and 64 texts at most."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= target or len(held) == 64:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class CentroidModel:
    """idf weights, the centroids with their languages, the rejection floors
    (a row for each centroid, a column for each size of a text)."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    floors: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines and rejections."""
        languages, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rejected = np.ones(len(texts), bool)
        real = [i for i, t in enumerate(texts) if t and has_letter(t)]
        if len(self.centroids) and real:
            at = 0
            for block in blocks([texts[i] for i in real]):
                counts = ngram_counts(block)
                cosine = self.vectors(counts) @ self.centroids.T
                best = cosine.argmax(axis=1)
                floors = self.floors[best, sizes(counts)]
                for k, c in enumerate(best):
                    i = real[at + k]
                    languages[i], scores[i] = self.languages[c], min(1.0, max(0.0, float(cosine[k, c])))
                    rejected[i] = scores[i] < floors[k]
                at += len(block)
        return languages, scores, rejected


def spherical_kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; seeding spreads over the least covered rows."""
    rng = np.random.default_rng(seed)
    centroids = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        cover = (x @ np.stack([c / max(np.linalg.norm(c), 1e-12) for c in centroids]).T).max(axis=1)
        gap = np.maximum(1 - cover, 0) ** 2
        centroids.append(x[rng.choice(len(x), p=gap / gap.sum())] if gap.sum() > 0 else x[0])
    found = np.stack(centroids)
    for _ in range(rounds):
        found = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        own = (x @ found.T).argmax(axis=1)
        found = np.stack([x[own == j].mean(axis=0) if (own == j).any() else found[j] for j in range(len(found))])
    return (found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def learn_floors(measured: dict[str, list[tuple[int, float]]], languages: list[str]) -> np.ndarray:
    """A floor for every language and size from (size, cosine) of its
    documents. Sizes with fewer than ``LEAST`` documents take those of all
    languages, or else the floor of the size below, so no text is held to what
    only longer ones reach."""
    everything = [m for found in measured.values() for m in found]

    def floor(found: list[tuple[int, float]], size: int) -> float | None:
        cosines = [c for s, c in found if s == size]
        return MARGIN * float(np.quantile(cosines, 0.01)) if len(cosines) >= LEAST else None

    shared = [floor(everything, size) for size in range(SIZES)]
    out = np.zeros((len(languages), SIZES))
    for lang in set(languages):
        below = 0.0
        for size in range(SIZES):
            own = floor(measured.get(lang, []), size)
            below = own if own is not None else below if shared[size] is None else shared[size]
            out[[i for i, x in enumerate(languages) if x == lang], size] = below
    return out


def fit(
    learnable: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 600,
    clusters: int = 4,
) -> CentroidModel:
    """Learn from the rows of ``learnable`` with a language and a letter."""
    ship(learnable.sparkSession)
    rows = learnable.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")).alias("hash"),  # of the text if the id is NULL
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                total += (ngram_counts(block) > 0).sum(axis=0)
                n += len(block)
        buckets = pa.array(np.arange(DIM + 1), pa.int32())
        yield pa.RecordBatch.from_arrays([buckets, pa.array([*total.tolist(), n], pa.int64())], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(frequencies, "bucket int, n long")
    df = np.zeros(DIM + 1)  # DIM + 1 rows reach the driver
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1

    # The smallest hashes lie under a threshold that about three times the
    # sample passes, so few rows of a common language reach its window.
    share = F.least(F.lit(1.0), F.lit(3.0 * per_language) / F.approx_count_distinct("hash"))
    shares = rows.groupBy("lang").agg(share.alias("_share"))
    low = (F.col("hash").cast("double") / 2.0**64 + 0.5) <= F.col("_share")
    few = rows.select("id", "hash", "lang").join(F.broadcast(shares), "lang").where(low).select("id", "hash", "lang").distinct()
    by_hash = Window.partitionBy("lang").orderBy("hash", "id")
    sample = few.withColumn("_r", F.row_number().over(by_hash)).where(f"_r <= {per_language}")
    sample = sample.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.col("lang").alias("_lang"))
    own = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")) & (F.col("lang") == F.col("_lang"))
    picked = rows.join(F.broadcast(sample), own).dropDuplicates(["lang", "id", "hash"]).select("lang", "text")  # bounded sample
    picked = materialize(picked, "language-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in blocks(batch.column(1).to_pylist()):
                counts = ngram_counts(block).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(block)), pa.array([c.tobytes() for c in counts], pa.binary())],
                    ["lang", "counts"],
                )
                at += len(block)

    held = picked.mapInArrow(vectors, "lang string, counts binary").collect()  # at most per_language a language
    model = CentroidModel(idf, np.empty((0, DIM), np.float32), [], np.zeros((0, SIZES)))
    halves: dict[tuple[str, int], np.ndarray] = {}
    for lang in sorted({r["lang"] for r in held}):
        raw = sorted(bytes(r["counts"]) for r in held if r["lang"] == lang)
        x = model.vectors(np.stack([np.frombuffer(c, np.uint32) for c in raw]).astype(float))
        half = np.array([zlib.crc32(c) & 1 for c in raw])
        for h in (0, 1):
            if (half != h).any():
                halves[lang, h] = spherical_kmeans(x[half != h], clusters, seed=len(model.languages))
        found = spherical_kmeans(x, clusters, seed=len(model.languages))
        model.centroids = np.concatenate([model.centroids, found])
        model.languages += [lang] * len(found)

    def measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, float]] = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = ngram_counts(beginnings(text))
                own = counts[-1].astype(np.uint32).tobytes()
                others = halves.get((lang, zlib.crc32(own) & 1))
                if others is not None:
                    cosines = (model.vectors(counts) @ others.T).max(axis=1)
                    out += zip([lang] * len(counts), sizes(counts).tolist(), cosines.tolist())
            columns = list(zip(*out)) or [(), (), ()]
            kinds = (pa.string(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "size", "cosine"])

    measured: dict[str, list[tuple[int, float]]] = {}
    for r in picked.mapInArrow(measures, "lang string, size int, cosine double").collect():  # ten a document at most
        measured.setdefault(r["lang"], []).append((r["size"], r["cosine"]))
    model.floors = learn_floors(measured, model.languages)
    return model


def predictor(model: CentroidModel):
    """A column function: text -> struct(lang_pred, score, rejected)."""

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            languages, scores, rejected = model.predict(texts.to_pylist())
            found = [pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.StructArray.from_arrays(found, ["lang_pred", "score", "rejected"])
        release()

    return predict.asNondeterministic()  # so that a filter on it is not a second evaluation


def identify(docs: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row, from its whole text."""
    ship(docs.sparkSession)
    found = docs.select(F.col(id_col).cast("long").alias(id_col), predictor(model)(F.col(text_col).cast("string")).alias("_p"))
    return found.select(id_col, "_p.lang_pred", "_p.score", "_p.rejected")


def held_out(id_col: str = "doc_id") -> Column:
    """crc32(id as text) mod 4 is 2; a NULL id is not held out."""
    from playlens.llm.common import fold

    return F.coalesce(fold(id_col, 4) == 2, F.lit(False))
