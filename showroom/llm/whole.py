"""Vectors of whole numbers and their exact inner products.

Components stay doubles, which hold every whole number that scaling a double by a power of two can give. A product of two
vectors is exact at any size; beyond 64 bits it counts as the nearest number of 64 bits, in orders and in results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_LARGEST = float(np.finfo(np.float64).max)
LEAST, MOST = -(2**63), 2**63 - 1


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component as doubles, or null if one is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        y = F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST))
        return F.when(F.abs(y) >= float(2**52), y).otherwise(F.floor(y).cast("double"))

    return F.when(fine, F.transform(vector, whole))


def small(q: np.ndarray, largest: float) -> bool:
    """Whether sums of products of ``q`` with components up to ``largest`` are exact in doubles."""
    return float(np.abs(q).max(initial=0)) * largest * max(1, len(q)) < 2**53


def products(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of one vector with the rows of a matrix (doubles of whole numbers), as 64-bit numbers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, len(q))
    if most < 2**53:
        return (rows @ q).astype(np.int64)
    if most < 2**62 and np.abs(q).max() < 2**62 and np.abs(rows).max() < 2**62:
        return rows.astype(np.int64) @ q.astype(np.int64)
    mine = [int(x) for x in q.tolist()]
    exact = [sum(int(a) * b for a, b in zip(row, mine, strict=True)) for row in rows.tolist()]
    return np.array([min(max(x, LEAST), MOST) for x in exact], np.int64)


def matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """A column of equally long lists of numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
