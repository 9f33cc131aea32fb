"""Tables of vectors as whole numbers, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column, scale: int, largest: int, kind: str = "long") -> Column:
    """``floor(scale * c)`` of every component, between ``-largest`` and ``largest``.

    The product is a double; it is limited before it becomes a whole number, so no component overflows."""
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(F.lit(scale) * c.cast("double"), F.lit(float(-largest))), F.lit(float(largest)))).cast(kind))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def common_length(rows: DataFrame, vector_col: str) -> int | None:
    """The length that most vectors have, of equally frequent ones the larger; None for an empty table."""
    lengths = rows.groupBy(F.size(vector_col).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return None if first is None else first["length"]


def matrix(column: pa.Array, dims: int, kind=np.int64) -> np.ndarray:
    """The vectors of a column of lists (no nulls, all of length ``dims``) as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dims)
