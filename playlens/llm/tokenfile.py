"""Token-id files: one concatenated id array per shard file with Elias-Fano
coded document boundaries, in ascending id order over all shards.

A shard file holds, in this order: the ids of its documents side by side
(unsigned little-endian, 2 bytes each when the vocabulary fits, else 4); the
Elias-Fano boundaries (the end of every document, so ``select(i)`` gives an
offset without a 64-bit table); the document ids as an Elias-Fano sequence
of distances from the smallest; and a fixed footer with the section lengths.

Spark orders the documents by range (``repartitionByRange``), every task
tokenizes and writes one file to the folder named by ``spark.checkpoint.dir``
under a name of its own, and the manifest (one row per file) is written by
Spark. Only files named by the manifest count, so retried or speculative
tasks are harmless and a lost executor costs a rerun of its tasks.

Defined results: a NULL text is the empty text (only the end id); documents
with a NULL id come first and keep a NULL id; rows with equal ids stay
separate documents, ordered by their text's hash; an empty table has an empty
manifest. A third of all rows sharing one id are still split over tasks (the
range includes the text hash and a row number).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlens.config import materialize, scratch_path
from playlens.llm.batches import text_slices
from playlens.llm.common import ship
from playlens.llm.eliasfano import EliasFano
from playlens.llm.libtokens import ENCODED_BYTES, ENCODED_ROWS, default_tokenizer, library_encoder
from playlens.llm.workercache import give_back

MAGIC = b"EFTOK1\0\0"
#: magic, width of an id, documents, NULL ids, smallest id, bytes of the three sections
_FOOTER = struct.Struct("<8sQQQqQQQ")
#: Documents whose boundaries a sequential reader decodes at a time.
RUN = 8192
MANIFEST = "first_id long, first_hash long, first_row long, path string, n_docs long, n_ids long"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and path of a URI or of a plain path."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return pafs.LocalFileSystem(), uri


# -- one file ---------------------------------------------------------------
class ShardWriter:
    """Streams documents into one shard file; memory is one id and one
    boundary per document."""

    def __init__(self, uri: str, width: int):
        self.store, self.path = filesystem(uri)
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.type = self.store.open_output_stream(self.path), np.dtype(f"<u{width}")
        self.ends, self.ids, self.nulls, self.total = [], [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(self.type).tobytes())
        self.total += len(ids)
        self.ends.append(self.total)
        if doc_id is None:
            self.nulls += 1
        else:
            self.ids.append(doc_id)

    def close(self) -> None:
        least = self.ids[0] if self.ids else 0
        ends = EliasFano.of(np.array(self.ends, dtype=np.uint64)).to_bytes()
        ids = EliasFano.of(np.array([i - least for i in self.ids], dtype=np.uint64)).to_bytes()
        self.out.write(ends)
        self.out.write(ids)
        sizes = (self.total * self.type.itemsize, len(ends), len(ids))
        self.out.write(_FOOTER.pack(MAGIC, self.type.itemsize, len(self.ends), self.nulls, least, *sizes))
        self.out.close()


class ShardReader:
    """Random and sequential access to one shard file."""

    def __init__(self, uri: str):
        store, path = filesystem(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        footer = self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        magic, width, self.n_docs, self.nulls, self.least, n_ids, n_ends, n_docs = _FOOTER.unpack(footer)
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.type = np.dtype(f"<u{width}")
        self.ends = EliasFano.from_bytes(self.file.read_at(n_ends, n_ids))
        self._ids = EliasFano.from_bytes(self.file.read_at(n_docs, n_ids + n_ends))

    def bounds(self, i: int) -> tuple[int, int]:
        """Start and end of document ``i`` in the id array, by two selects."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return np.frombuffer(self.file.read_at((end - start) * self.type.itemsize, start * self.type.itemsize), self.type)

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        """The ids of documents ``first`` to ``last`` - 1."""
        nulls = max(0, min(last, self.nulls) - first)
        known = self._ids.part(max(first - self.nulls, 0), max(last - self.nulls, 0))
        return [None] * nulls + [int(v) + self.least for v in known]

    def blocks(self, target: int = 1 << 21) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first document, ends, ids) of runs of documents of about ``target``
        ids and at most ``RUN`` documents. A run's ends are decoded from the
        sampled select, so a reader holds one block at a time."""
        first, at, width = 0, 0, self.type.itemsize
        while first < self.n_docs:
            ends = self.ends.part(first, first + RUN).astype(np.int64)
            ends = ends[: max(1, int(np.searchsorted(ends, at + target, side="right")))]
            stop = int(ends[-1])
            yield first, ends - at, np.frombuffer(self.file.read_at((stop - at) * width, at * width), self.type)
            first, at = first + len(ends), stop


# -- the whole table --------------------------------------------------------
def write_token_files(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    folder: str | None = None,
) -> DataFrame:
    """Write shard files; returns the manifest (shard, path, n_docs, n_ids,
    start), start being the ids in all shards before."""
    spark = docs.sparkSession
    path, folder = tokenizer or default_tokenizer(), folder or scratch_path(spark, "token-files")
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, first = library_encoder(path), None, None
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        end = struct.pack("<I", end_id)
        for batch, texts in text_slices(batches, 3, ENCODED_BYTES, ENCODED_ROWS):
            for k, (doc_id, ids) in enumerate(zip(batch.column(0).to_pylist(), encoder.encode_all(texts))):
                if writer is None:
                    uri = f"{folder}/shard-{uuid.uuid4().hex}.tok"
                    writer, first = ShardWriter(uri, width), [batch.column(c)[k].as_py() for c in range(3)]
                writer.add(doc_id, np.frombuffer(ids + end, dtype="<u4"))
        give_back()
        if writer is not None:
            writer.close()
            row = [*first, uri, len(writer.ends), writer.total]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.string() if c == 3 else pa.int64()) for c, v in enumerate(row)],
                ["first_id", "first_hash", "first_row", "path", "n_docs", "n_ids"],
            )

    keyed = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).cast("string").alias("text"),
    )
    order = ["id", "hash", "row"]
    written = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, MANIFEST)
    written = materialize(written, "token-manifest")
    by_first = Window.orderBy("first_id", "first_hash", "first_row")  # one row per file
    return written.select(
        (F.row_number().over(by_first) - 1).alias("shard"),
        "path",
        "n_docs",
        "n_ids",
        (F.sum("n_ids").over(by_first) - F.col("n_ids")).alias("start"),
    )


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, shard, start, n_tokens, ids_crc32) of every document, read back
    from the files; start counts the ids of all documents before it."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, base in zip(*(batch.column(c).to_pylist() for c in range(3))):
                reader, before = ShardReader(path), base
                for first, ends, ids in reader.blocks():
                    wide, bounds = ids.astype("<u4"), np.concatenate([[0], ends])
                    crcs = [zlib.crc32(wide[a:b]) for a, b in zip(bounds[:-1].tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids(first, first + len(ends)), pa.int64()),
                            pa.array(np.full(len(ends), shard), pa.int64()),
                            pa.array(before + bounds[:-1], pa.int64()),
                            pa.array(np.diff(bounds), pa.int64()),
                            pa.array(crcs, pa.int64()),
                        ],
                        ["id", "shard", "start", "n_tokens", "ids_crc32"],
                    )
                    before += int(ends[-1])

    schema = "id long, shard long, start long, n_tokens long, ids_crc32 long"
    files = manifest.select(F.col("shard").cast("long"), "path", F.col("start").cast("long"))
    return files.repartition("path").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def read_document(spark: SparkSession, manifest: DataFrame, shard: int, i: int) -> np.ndarray:
    """The ids of document ``i`` of one shard: a point read by two selects."""
    row = manifest.where(F.col("shard") == shard).select("path").first()
    return ShardReader(row["path"]).document(i)
