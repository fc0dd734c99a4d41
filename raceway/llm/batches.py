"""Arrow batches cut to a size, for the operators that work on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``size`` bytes (or list items) in one column."""
    values = batch.column(column)
    length = pc.binary_length(values) if pa.types.is_string(values.type) else pc.list_value_length(values)
    run = np.cumsum(pc.fill_null(length, 0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    return (batch.slice(x, y - x) for x, y in zip(edges, edges[1:]) if y > x)
