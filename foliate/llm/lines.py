"""Lines of texts as Arrow arrays, shared by the operators that work line by line."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces between the newlines of every text, the row each comes from and its number from 0. Null texts have none."""
    lists = pc.split_pattern(texts, "\n")
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(counts) - counts
    return lists.flatten(), row, np.arange(len(row)) - begins[row]


def slices(batch: pa.RecordBatch, column: int, limit: int = 8 << 20):
    """The batch in slices of about `limit` bytes of text, so that a worker's memory doesn't follow the batch's."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
