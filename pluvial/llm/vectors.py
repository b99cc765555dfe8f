"""Vectors of an embedding column, as both vector operators read them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Not null, of finite components only, and not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of equally long arrays as doubles."""
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def with_usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that can be compared and named; negative
    zeros become zeros."""
    return (vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)).alias("embedding")))
