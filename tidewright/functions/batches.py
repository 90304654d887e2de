"""Arrow batches in runs of rows, so that what Python holds at a time does not follow the size of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text, or values of lists, that are turned into Python objects at a time.
RUN_BYTES, RUN_VALUES = 1 << 20, 1 << 16


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """First and end row of runs whose sizes add up to at most ``most``; a larger row is alone."""
    ends = np.cumsum(sizes, dtype=np.int64)
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield i, j
        i = j


def text_runs(texts: pa.Array, most: int = RUN_BYTES) -> Iterator[pa.Array]:
    """Runs of whole texts; each row counts for what a Python string takes beside its bytes, too."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    for i, j in runs(sizes, most):
        yield texts.slice(i, j - i)


def list_runs(batch: pa.RecordBatch, column: str, most: int = RUN_VALUES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose lists in ``column`` have at most ``most`` values; a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    for i, j in runs(sizes, most):
        yield batch.slice(i, j - i)
