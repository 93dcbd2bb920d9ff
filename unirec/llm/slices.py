"""Arrow batches cut by the bytes they hold, so that a Python worker's memory does not follow the length of the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batch: pa.RecordBatch, columns: int | list[int], max_bytes: int, max_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows whose texts in ``columns`` have at most ``max_bytes`` together; a longer row is a
    slice of its own.  Nulls have no bytes; an empty batch has no slices."""
    total = np.zeros(batch.num_rows + 1, np.int64)
    for column in [columns] if isinstance(columns, int) else columns:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total[1:] += np.cumsum(size, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(total, total[at] + max_bytes, "right")) - 1
        end = min(max(end, at + 1), at + max_rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
