"""What the two vector operators share: usable vectors, and classes of equal ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import stage


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0.0)


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Staged rows (id, vector, class): usable vectors, ``class`` a hash that equal ones share.

    Two different vectors share a hash with a chance of 2^-64 a pair; ``same`` tells them apart.
    """
    kept = vectors.where(usable(vector_col)).select(
        F.col(id_col).alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double") + 0.0).alias("vector")
    )
    return stage(kept.withColumn("class", F.xxhash64("vector")), "vectors")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one width as rows of doubles."""
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
