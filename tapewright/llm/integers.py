"""Vectors of whole numbers, for distances and products that are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import col

# Sums of products up to here are exact in double precision, whatever their order.
EXACT = 1 << 53


def scaled(vectors: DataFrame, scale: int, largest: int, vec_id: str, vector: str, *others: str) -> DataFrame:
    """``vec_id``, ``x`` (floor of ``scale`` times each component) and the other columns.

    Vectors that are null or hold a null or non-finite component are left out, and so are those
    whose squared length, scaled, is not below ``largest``: their products would not fit a long.
    """
    v = F.col("v")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 31)))
    rows = vectors.select(
        col(vec_id).cast("long").alias("vec_id"),
        col(vector).cast("array<double>").alias("v"),
        *(col(c).alias(c) for c in others),
    ).where(v.isNotNull() & whole)
    rows = rows.withColumn("v", F.transform(v, lambda x: F.floor(x * scale).cast("double")))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return rows.where(length < float(largest)).select(
        "vec_id", F.transform("v", lambda x: x.cast("long")).alias("x"), *others
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The lists of an Arrow column, all of ``dim`` numbers, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def packed(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    longest = [float((x.astype(np.float64) ** 2).sum(1).max()) for x in (a, b)]
    if longest[0] * longest[1] < float(EXACT) ** 2:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    a, b = a.astype(np.int64), b.astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        out += a[:, i : i + 1] * b[:, i]
    return out
