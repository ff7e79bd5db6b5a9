"""What the operators on embeddings share: which vectors take part, and their numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def takes_part(vector: Column) -> Column:
    """Not null or zero, and without null or non-finite components."""
    broken = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    return vector.isNotNull() & ~broken & F.exists(vector, lambda x: x != 0)


def lengths(vectors: DataFrame, vector: str) -> list[int]:
    """The lengths that the vectors have, ascending: one for each model that made some."""
    sizes = vectors.select(F.size(vector).alias("size")).distinct()
    return sorted(row["size"] for row in sizes.collect())


def matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """The rows of a list column, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, length)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, also where squares of components would overflow or vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def bounded_sample(vectors: DataFrame, row: str, vector: str, most: int, length: int) -> np.ndarray:
    """At most ``most`` vectors on the driver, drawn by a hash of their row number."""
    drawn = vectors.orderBy(F.xxhash64(row), row).limit(most).select(vector).toArrow()
    return matrix(drawn[vector], length) if drawn.num_rows else np.zeros((0, length))
