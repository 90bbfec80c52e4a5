"""What the operators on embeddings share: which vectors take part, and arrays of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not zero, and without NULL or non-finite components."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(
        vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def stacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean norms, scaled first so that no square overflows or vanishes."""
    largest = np.abs(vectors).max(axis=1)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(axis=1))
