"""Vectors in columns of arrays, as numpy matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(embedding: str = "embedding") -> Column:
    """Whether the array is there and none of its components is null, NaN or infinite."""
    inside = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    return F.coalesce(F.forall(embedding, inside), F.lit(False))


def by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length that the arrays have; arrays without nulls are asked for."""
    offsets = column.offsets.to_numpy()
    sizes, values = np.diff(offsets), column.values.to_numpy(zero_copy_only=False).astype(float)
    out = []
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        out.append((rows, values[offsets[rows][:, None] + np.arange(n)]))
    return out


def whole(x: np.ndarray, scale: int, most: int) -> np.ndarray:
    """floor(scale * x) as integers, beyond `most` as `most`."""
    return np.clip(np.floor(scale * x), -most, most).astype(np.int64)
