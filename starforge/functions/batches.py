"""Working through Arrow batches in parts, so that a worker's memory does not follow their size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts of a part, and bytes of them unless a single one is longer.
PART_ROWS, PART_BYTES = 512, 1 << 20


def text_parts(batches: Iterable[pa.Array], rows: int = PART_ROWS, size: int = PART_BYTES) -> Iterator[list]:
    """All texts in order, as lists of bounded size; a batch is let go of before the next is read."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            fitting = int(np.searchsorted(ends, before + size, side="right"))
            stop = min(start + rows, max(start + 1, fitting))
            yield batch.slice(start, stop - start).to_pylist()
            start = stop
        del batch
