"""Join shapes that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this share of the rows, and at least so many.
HOT_SHARE, HOT_ROWS = 0.01, 1_000_000
#: Keys that the sketch of a table follows for each that can be hot, so that no hot one is missed.
TRACKED = 20
#: Parts that a hot key's rows are cut into.
SALTS = 64
#: A lookup table of up to this many bytes is broadcast.
LOOKUP_BYTES = 64 << 20


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, rows: int = HOT_ROWS) -> list[tuple]:
    """The keys that hold more than ``share`` of the rows of ``df``, and ``rows`` at least.

    One pass over the key columns: a frequent-items sketch of bounded size per task,
    merged to one row; what it names is then counted exactly.  There are at most 1 / share
    such keys, and the driver gets no others.  A key with a NULL in it matches nothing
    and is never hot.
    """
    named = df.select(*keys).where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    hashed = named.select(F.xxhash64(*keys).alias("h"))
    most = math.ceil(1 / share)
    row = hashed.agg(F.count("*").alias("n"),
                     F.expr(f"approx_top_k(h, {2 * most}, {max(1000, TRACKED * most)})").alias("top")).first()
    least = max(share * row["n"], rows)
    # the sketch errs by less than half of a hot key's rows: a margin, then exact counts
    found = [r["item"] for r in row["top"] or [] if 2 * r["count"] >= least]
    if not found:
        return []
    counted = named.where(F.xxhash64(*keys).isin(found)).groupBy(*keys).agg(F.count("*").alias("n"))
    return [tuple(r[k] for k in keys) for r in counted.where(F.col("n") >= least).collect()]


def among(keys: Sequence[str], hot: Sequence[tuple]) -> Column:
    alike = [reduce(lambda a, b: a & b, (F.col(k) == F.lit(v) for k, v in zip(keys, values))) for values in hot]
    return F.coalesce(reduce(lambda a, b: a | b, alike), F.lit(False))


def every_salt(is_hot: Column, salts: int) -> Column:
    zero, last = (F.lit(n).cast("long") for n in (0, salts - 1))
    return F.when(is_hot, F.sequence(zero, last)).otherwise(F.array(zero))


def left_join_hot(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: Sequence[tuple],
                  salts: int = SALTS) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` with the rows of ``hot`` keys spread.

    AQE splits a skewed partition of the preserved side only, so a hot key on
    the right would stay in one task.  Here a hot key's right rows go to ``salts``
    parts by their own hash, and its left rows to each of them; all other
    keys have one part.  Every hot key stands on the right, so a copy of a left
    row that finds nothing in its part has found it in another: it is dropped.
    Without hot keys this is the plain left join.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    if not hot:
        return left.join(right, keys, "left").select(*left.columns, *payload)
    is_hot = among(keys, hot)
    spread = right.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*right.columns), F.lit(salts))).otherwise(0)) \
        .withColumn("_there", F.lit(True))
    copies = left.withColumn("_hot", is_hot).withColumn("_salt", F.explode(every_salt(is_hot, salts)))
    joined = copies.join(spread, [*keys, "_salt"], "left")
    return joined.where(~F.col("_hot") | F.col("_there").isNotNull()).select(*left.columns, *payload)


def byte_size(df: DataFrame) -> int:
    """Bytes of the values of a table, counted: what a copy of it takes at least."""
    one = F.lit(0).cast("long")
    for f in df.schema.fields:
        size = F.octet_length(F.col(f.name).cast("string")).cast("long") if f.dataType.simpleString() in (
            "string", "binary") else F.lit(16).cast("long")
        one = one + F.coalesce(size, F.lit(0).cast("long")) + F.lit(8)
    return df.agg(F.sum(one)).first()[0] or 0


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], limit: int = LOOKUP_BYTES,
                share: float = HOT_SHARE, rows: int = HOT_ROWS) -> DataFrame:
    """``big LEFT JOIN small``, without moving ``big`` while ``small`` is small.

    The lookup table's bytes are counted first.  Up to ``limit`` it is broadcast;
    beyond, both sides are shuffled and the hot keys of ``big`` are cut into parts that
    each get a copy of their lookup rows.
    """
    keys = list(keys)
    payload = [c for c in small.columns if c not in keys]
    if byte_size(small) <= limit:
        return big.join(F.broadcast(small), keys, "left").select(*big.columns, *payload)
    hot = hot_keys(big, keys, share, rows)
    if not hot:
        return big.join(small, keys, "left").select(*big.columns, *payload)
    is_hot = among(keys, hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*big.columns), F.lit(SALTS))).otherwise(0)
    return (big.withColumn("_salt", salt)
            .join(small.withColumn("_salt", F.explode(every_salt(is_hot, SALTS))), [*keys, "_salt"], "left")
            .select(*big.columns, *payload))
