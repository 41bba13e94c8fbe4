"""Helpers for functions on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of one binary column.

    A row is never split, so a piece holds one row at least.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        upto = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The values of a binary column; null is empty."""
    return [x or b"" for x in batch.column(column).to_pylist()]
