"""Arrow batches inside tasks: slices bounded by bytes, and groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024


def text_slices(
    batches: Iterator[pa.RecordBatch], column: int, target: int = SLICE_BYTES, rows: int = SLICE_ROWS
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """(slice, its texts as UTF-8, NULL as empty): every slice has at most
    ``rows`` rows and ``target`` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + target, side="right"))
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            part = batch.slice(start, stop - start)
            yield part, part.column(column).cast(pa.binary()).fill_null(b"").to_pylist()
            start = stop


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(columns, starts) of the whole groups of a partition sorted by its first
    ``n_keys`` columns: the numeric columns of a run of rows and the first row
    of each group in it, with the number of rows at the end. A group is never
    cut; only the last group of a batch is carried to the next one."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate(p) for p in zip(held, now)]
        cut = _starts(now[:n_keys])
        last = int(cut[-2])
        if last:
            yield [c[:last] for c in now], cut[:-1]
        held = [c[last:] for c in now]
    if held is not None:
        yield held, np.array([0, len(held[0])])


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    changed = np.zeros(len(keys[0]) - 1, bool)
    for k in keys:
        changed |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [len(keys[0])]])
