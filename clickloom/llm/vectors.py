"""Vectors of an array column as matrices, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def component_kind(df: DataFrame, column: str) -> np.dtype:
    """float32 for arrays of floats, which it holds exactly, and float64 for others."""
    element = df.schema[column].dataType.elementType
    return np.dtype(np.float32 if isinstance(element, T.FloatType) else np.float64)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the places of the rows of that length and their matrix in
    double precision. Null rows and rows that hold a null, a NaN or an infinity are
    left out, and so are rows without components."""
    if not len(column):
        return
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null is NaN
    lengths = np.diff(offsets)
    lengths[~column.is_valid().to_numpy(zero_copy_only=False)] = 0
    for length in np.unique(lengths[lengths > 0]).tolist():
        places = np.flatnonzero(lengths == length)
        matrix = values[offsets[places][:, None] + np.arange(length)]
        whole = np.isfinite(matrix).all(axis=1)
        if whole.any():
            yield places[whole], matrix[whole]
