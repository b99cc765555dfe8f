"""Idempotent upserts on immutable files (B1 ignore, B2 replace).

Parquet tables cannot be updated in place, so an upsert is expressed as a
new version: ``target UNION (batch minus existing keys)``.  "First row wins"
and "last row wins" are ``row_number() = 1`` per key; Catalyst plans a
partial WindowGroupLimit before the shuffle, so every task keeps one row
per key before anything moves and a key holding a third of the batch never
lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__row_in_key"
_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _pick(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
          last: bool) -> DataFrame:
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)}
    # the payload breaks ties, so the winner does not depend on task timing
    ties = [F.col(f.name) for f in batch.schema.fields
            if f.name not in keys and f.name not in named
            and not isinstance(f.dataType, _UNORDERABLE)]
    ordering = [(c.desc_nulls_last() if last else c.asc_nulls_first())
                for c in order_cols + ties]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return batch.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def first_wins(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the smallest by ``order`` (ties broken by the payload)."""
    return _pick(batch, keys, order, last=False)


def last_wins(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the largest by ``order`` (ties broken by the payload)."""
    return _pick(batch, keys, order, last=True)


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a NULL in it): the second part cannot be
    stored under a key constraint and belongs in a reject table."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond), df.where(~cond)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing when a row with a NULL key is read."""
    return df.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL key in column {k}"))
                                         .cast(df.schema[k].dataType)) for k in keys})


def upsert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING.

    Existing keys keep their row; inside the batch the first row in
    ``order`` wins.  A row with a NULL key violates the key constraint and
    fails the load; ``split_null_keys`` takes such rows off beforehand.
    Re-running with the same batch returns the same table (idempotent).
    """
    return target.unionByName(fresh_rows(batch, keys, order, target).select(*target.columns))


def fresh_rows(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               target: DataFrame | None = None) -> DataFrame:
    """What an ignoring upsert appends: the first row of each key that the
    target (of which only the keys are read) does not hold yet."""
    fresh = first_wins(_keyed(batch, keys), keys, order)
    return fresh if target is None else fresh.join(target.select(*keys), on=list(keys), how="left_anti")


def upsert_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   order: Sequence[str | Column]) -> DataFrame:
    """INSERT ... ON CONFLICT DO UPDATE (every non-key column replaced).

    A key repeated inside the batch keeps its last row in ``order``;
    ``duplicate_keys`` reports such keys.
    """
    batch = _keyed(batch, keys)
    latest = last_wins(batch, keys, order).select(*target.columns)
    kept = target.join(latest.select(*keys), on=list(keys), how="left_anti")
    return kept.unionByName(latest)


def duplicate_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a batch, with their row count."""
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
