"""Document quality by random-indexing word vectors and a small network.

1. Random indexing: every word has a fixed sparse random vector (four entries
   of +-1, from its hash); the vector of a word is the sum of the sparse
   vectors of its neighbours (two words to either side) over the whole corpus.
   Words share ``WORDS`` hashed rows (a vector belongs to a row, not to one
   word), and their shapes (case and signs, runs collapsed) have ``SHAPES`` rows
   of their own, so the table is a fixed few MB whatever the vocabulary.
   Sums are formed per task and added up by Spark.
2. A document is the mean and the spread of the vectors of its words and
   shapes, and its length on a log scale, over its whole text.
3. A two-layer network (numpy) is fitted on a bounded sample of the labelled
   rows (``sample`` rows with the smallest hash of their id and text), and a
   temperature fitted on a part of them it has not seen calibrates its
   probabilities.

Labels are the only thing learned from; id, source and language are never
inputs. Defined results: a NULL or empty text is pooled to zeros and scored
like any other; NULL labels are ignored; with labels of one kind only, or
none, every score is that kind's share (0.5 without any); an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.batches import text_slices
from playlens.llm.common import fold, ship
from playlens.llm.workercache import BoundedCache, hold, release

WORDS, SHAPES, DIM, ENTRIES, REACH = 8192, 1024, 32, 4, 2
ROWS = WORDS + SHAPES
FEATURES = 4 * DIM + 1
THRESHOLD = 0.3
#: Words counted and pooled at a time (the pooled vectors of 8,192 words fit a core's cache).
COUNTED, POOLED = 1 << 18, 1 << 13
#: Text that a task turns into Python objects at a time.
TEXT_BYTES = 2 << 20


# -- words ------------------------------------------------------------------
_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("9") if 48 <= b <= 57 else ord("a") if 97 <= b <= 122 or b >= 128 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_EDGES = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class WordRows(BoundedCache):
    """word -> (row of the word) * ROWS + (row of its shape), per worker."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        core = word.strip(_EDGES).lower() or word
        shape = _RUNS.sub(rb"\1", word.translate(_SHAPE))
        rows = xxhash.xxh3_64_intdigest(core) % WORDS * ROWS + WORDS + xxhash.xxh3_64_intdigest(shape) % SHAPES
        self.keep(word, rows)
        return rows


def word_rows(texts: list[bytes], chunk: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, words of each text, word rows, shape rows) in runs of
    whole texts of about ``chunk`` words."""
    lookup = hold("quality-words", WordRows).__getitem__
    first, counts, held = 0, [], []
    total = 0
    for i, text in enumerate(texts):
        words = text.split()
        held.append(np.fromiter(map(lookup, words), np.int64, len(words)))
        counts.append(len(words))
        total += len(words)
        if total >= chunk or i == len(texts) - 1:
            both = np.concatenate(held)
            yield first, np.array(counts), both // ROWS, both % ROWS
            first, counts, held, total = i + 1, [], [], 0


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the entries of every row's sparse vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (ROWS, ENTRIES)), rng.choice([-1.0, 1.0], (ROWS, ENTRIES))


# -- word vectors -----------------------------------------------------------
def add_contexts(table: np.ndarray, counts: np.ndarray, words: np.ndarray, shapes: np.ndarray, entries) -> None:
    """Add the neighbours' sparse vectors to the rows of words and shapes."""
    positions, signs = entries
    doc = np.repeat(np.arange(len(counts)), counts)
    for away in range(1, REACH + 1):
        inside = np.flatnonzero(doc[away:] == doc[:-away])
        left, right = inside, inside + away
        for target, source in ((left, right), (right, left)):
            neighbour = words[source]
            for rows, near in ((words[target], neighbour), (shapes[target], neighbour), (shapes[target], shapes[source])):
                base = rows * DIM
                for e in range(ENTRIES):
                    table += np.bincount(base + positions[near, e], weights=signs[near, e], minlength=ROWS * DIM)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The ROWS x DIM unit vectors learned from all documents."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, entries = np.zeros(ROWS * DIM), index_vectors()
        for _, part in text_slices(batches, 0, TEXT_BYTES):
            for _, counts, words, shapes in word_rows(part, COUNTED):
                add_contexts(table, counts, words, shapes, entries)
        rows = table.reshape(ROWS, DIM)
        used = np.flatnonzero(rows.any(axis=1))
        flat = pa.array(rows[used].ravel())
        offsets = pa.array(np.arange(len(used) + 1) * DIM, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.ListArray.from_arrays(offsets, flat)], ["row", "v"])
        release()

    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    sums = texts.mapInArrow(run, "row int, v array<double>").select("row", array_to_vector("v").alias("v"))
    total = sums.groupBy("row").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v"))
    table = np.zeros((ROWS, DIM))
    for r in total.collect():  # at most ROWS rows
        table[r["row"]] = r["v"]
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of word and shape vectors and log length, a row a text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for first, counts, words, shapes in word_rows(texts, POOLED):
        full = np.flatnonzero(counts)
        if not len(full):
            continue
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        n = counts[full][:, None]
        for k, rows in enumerate((words, shapes)):
            v = vectors[rows]
            mean = np.add.reduceat(v, starts, axis=0, dtype=np.float64) / n
            square = np.add.reduceat(v * v, starts, axis=0, dtype=np.float64) / n
            at = 2 * k * DIM
            out[first + full, at : at + DIM] = mean
            out[first + full, at + DIM : at + 2 * DIM] = np.sqrt(np.maximum(square - mean**2, 0))
        out[first + full, -1] = np.log1p(counts[full])
    return out


# -- the network ------------------------------------------------------------
@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0
    prior: float | None = None  # set when there is nothing to learn from

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return _sigmoid(self.logits(pooled(texts, self.vectors).astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 3) -> QualityModel:
    """Fit the network on four fifths of the rows, the temperature on the rest."""
    share = float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    shapes = [(FEATURES, hidden), (hidden,), (hidden,), ()]
    weights = [rng.normal(0, 1 / np.sqrt(s[0]), s) if s and i != 1 else np.zeros(s) for i, s in enumerate(shapes)]
    model = QualityModel(vectors, mean, scale, weights)
    if len(np.unique(y)) < 2 or len(y) < 20:
        model.prior = share
        return model
    order = rng.permutation(len(y))
    tune, fit_rows = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - mean) / scale
    first, second, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for _ in range(epochs):
        rng.shuffle(fit_rows)
        for at in range(0, len(fit_rows), 128):
            rows = fit_rows[at : at + 128]
            h = np.tanh(z[rows] @ weights[0] + weights[1])
            error = (_sigmoid(h @ weights[2] + weights[3]) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), h.T @ error + 1e-4 * weights[2], error.sum()]
            step += 1
            for i, g in enumerate(grads):  # Adam
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                rate = 2e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[i] = weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    model.weights = weights
    logits = model.logits(x[tune])
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, np.where(y[tune] == 1, -logits, logits) / t).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = 8000,
) -> QualityModel:
    """Word vectors from all of ``docs``, the network from at most ``sample``
    labelled rows that are not held out."""
    vectors = word_vectors(docs, text_col)
    usable = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    usable = usable.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    # The sample is drawn on ids and hashes, before any text is read for it;
    # rows that repeat an id and its text are one.
    labelled = rows.select("id", "h").join(usable, "id").distinct()
    chosen = labelled.orderBy(F.xxhash64("id", "h"), "id", "h", "y").limit(sample)
    picked = rows.join(F.broadcast(chosen), ["id", "h"]).dropDuplicates(["id", "h", "y"])  # at most ``sample`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 1, TEXT_BYTES):
            x = [r.tobytes() for r in pooled(texts, vectors)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(x, pa.binary())], ["id", "y", "x"])
        release()

    held = picked.select("id", "text", "y").mapInArrow(run, "id long, y int, x binary").collect()
    held.sort(key=lambda r: (r["id"], r["y"], bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in held], np.float64).reshape(-1, FEATURES)
    return train(vectors, x, np.array([r["y"] for r in held], np.float64))


def scorer(spark: SparkSession, model: QualityModel):
    """A column function: text -> score in 0..1."""
    shared = spark.sparkContext.broadcast(model)  # a fixed few MB

    @F.arrow_udf("double")
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            whole = pa.RecordBatch.from_arrays([column], ["text"])
            scores = [shared.value.score(part) for _, part in text_slices(iter([whole]), 0, TEXT_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64())
        release()

    return found.asNondeterministic()  # so that a filter on it is not a second evaluation


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, from its whole text."""
    ship(docs.sparkSession)
    found = scorer(docs.sparkSession, model)(F.col(text_col).cast("string"))
    return docs.select(F.col(id_col).cast("long").alias(id_col), found.alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32(id as text) mod 5 is 0; a NULL id is not held out."""
    return F.coalesce(fold(id_col, 5) == 0, F.lit(False))
