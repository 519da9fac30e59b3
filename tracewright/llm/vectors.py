"""Vectors as numpy matrices inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(fine, F.lit(False))


def common_dimension(kept: DataFrame, vec: Column) -> int | None:
    """The length that most rows have (of several the least); None without rows."""
    got = kept.groupBy(F.size(vec).alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return None if got is None else int(got["d"])


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column whose lists all have length ``d`` and no nulls, as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)


def floored(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as int64, kept within -limit..limit."""
    return np.clip(np.floor(x * scale), -limit, limit).astype(np.int64)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of an int64 matrix as a list column."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel(), pa.int64()))
