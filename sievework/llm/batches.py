"""Arrow batches cut by size, so that long texts don't add up in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def steps(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose values in a column of strings or lists have at most ``limit`` bytes or items.

    A larger value stands alone. Nulls count 0.
    """
    for batch in batches:
        values = batch.column(column)
        length = pc.list_value_length(values) if pa.types.is_list(values.type) or pa.types.is_large_list(values.type) else pc.binary_length(values)
        size = np.cumsum(pc.fill_null(length, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + limit, "right")))
            yield batch.slice(low, high - low)
            low = high
