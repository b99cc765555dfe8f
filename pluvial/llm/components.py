"""Connected components of an edge table: alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) joined back to
the edges.  The minima are written to the shared folder before the join, so
the join's both sides are plain shuffles that adaptive execution can split
when one node holds a large share of the edges, and a lost executor repeats
one step only.  Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.llm.common import discard, materialize


def _star(edges: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(node, nb) rows joined to the smallest nb of the node, as (node, nb, least)."""
    least, path = materialize(
        edges.groupBy("node").agg(F.min("nb").alias("least")), f"{name}-least")
    return edges.join(least.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "inner") \
        .select("node", "nb", "least"), path


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "nb"))).first())


def connected_components(edges: DataFrame, a: str, b: str, name: str = "cc") -> DataFrame:
    """(node, component) of every node but the smallest of its component.

    ``a``/``b``: long columns; component: the smallest node reachable.  Loops,
    repeated links and null ends say nothing.  An empty table gives an empty
    result.
    """
    spark = edges.sparkSession
    now, path = materialize(
        edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("nb"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(),
        f"{name}-edges")
    sign = _sign(now)
    while sign[0]:
        # large star: a node's larger neighbours point to the smallest one near it
        both = now.union(now.select(F.col("nb").alias("node"), F.col("node").alias("nb")))
        joined, least_path = _star(both, name)
        large, large_path = materialize(
            joined.where(F.col("nb") > F.col("node"))
            .select(F.col("nb").alias("node"), F.least("node", "least").alias("nb")).distinct(),
            f"{name}-large")
        discard(spark, least_path)
        discard(spark, path)
        # small star: a node and its smaller neighbours point to the smallest of them
        joined, least_path = _star(large, name)
        now, path = materialize(
            joined.where(F.col("nb") != F.col("least")).select(F.col("nb").alias("node"), "least")
            .union(joined.select("node", "least")).distinct()
            .select("node", F.col("least").alias("nb")), f"{name}-small")
        discard(spark, least_path)
        discard(spark, large_path)
        before, sign = sign, _sign(now)
        if sign == before:
            break
    return now.select("node", F.col("nb").alias("component"))
