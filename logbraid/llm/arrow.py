"""Walking Arrow batches of texts in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

# Characters handled at once; one text is never cut.
PART_CHARS = 1 << 19


def in_parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """`batch` in slices whose texts in `column` hold some `PART_CHARS` bytes each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > PART_CHARS:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if batch.num_rows > first:
        yield batch.slice(first)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts, NULL as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
