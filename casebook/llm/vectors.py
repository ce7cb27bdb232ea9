"""Vector columns: which rows hold a usable vector, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """True where the vector is there, has components, and all of them are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def usual_width(sizes: DataFrame, column: str) -> int | None:
    """The most frequent value of ``column``, ties to the smaller; None without rows."""
    counts = sizes.groupBy(F.col(column).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), "width").first()
    return None if first is None else first["width"]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, every list of the same width, as a float64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
