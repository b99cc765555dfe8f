"""Top-k rows per group (G2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group under ``order`` (row_number, so
    exactly k rows when a group has that many; make ``order`` total for a
    deterministic result).  Catalyst plans a WindowGroupLimit before and after
    the shuffle, so each task keeps only k rows per group before moving them.
    """
    if k < 1:
        raise ValueError("k must be positive")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
