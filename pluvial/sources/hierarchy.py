"""Code hierarchy: entity parsing (A15) and breadth-first flattening (A16).

The warehouse crawled a classification API node by node: breadth-first from
a root, each URL fetched once, the first node (in queue order) that lists a
child becomes its parent.  Here the crawl has landed as

- ``entities``: one JSON document per node URL (code, title, definition)
- ``links``:    (parent_url, child_url, ordinal) - the child lists, with the
                position of the child in its parent's list (any orderable type)

and the walk is a level-synchronous frontier loop of joins: each level
joins the frontier to the links, drops URLs already visited (anti join) and
keeps, per new URL, the discoverer that comes first in queue order.  Queue
order of a node is the path of child positions from the root, so "first
discoverer" is the smallest (depth, path) - a row_number per URL that
Catalyst reduces map-side.  The visited set is checkpointed to the shared
checkpoint folder each level, so lineage stays one level deep.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvial.functions.exprs import code_from_url
from pluvial.session import reliable_checkpoint

ENTITY_SCHEMA = "code string, title struct<`@value`: string>, definition string"


def links_from_documents(docs: DataFrame, url_col: str = "url", doc_col: str = "doc") -> DataFrame:
    """API-shaped documents carry their children inline (``child`` array)."""
    kids = F.from_json(F.get_json_object(F.col(doc_col), "$.child"), "array<string>")
    return docs.select(F.col(url_col).alias("parent_url"),
                       F.posexplode(kids).alias("ordinal", "child_url")) \
        .select("parent_url", "child_url", "ordinal")


def parse_entities(docs: DataFrame, url_col: str = "url", doc_col: str = "doc") -> DataFrame:
    """(url, code, title, description) from entity documents.

    ``title`` is ``title.@value``; ``description`` is ``definition.@value``
    only when ``definition`` is an object (a plain string gives NULL).
    """
    parsed = F.from_json(F.col(doc_col), ENTITY_SCHEMA)
    definition = F.get_json_object(F.col(doc_col), "$.definition")
    is_object = F.json_object_keys(definition).isNotNull()
    return docs.select(
        F.col(url_col).alias("url"),
        parsed.getField("code").alias("code"),
        parsed.getField("title").getField("@value").alias("title"),
        F.when(is_object, F.get_json_object(definition, "$['@value']")).alias("description"),
    )


# The visited set is a union of checkpointed levels; every few levels it is
# checkpointed itself so that very deep hierarchies keep a short plan.
VISITED_CHECKPOINT_EVERY = 8


def walk(spark: SparkSession, links: DataFrame, root_url: str) -> DataFrame:
    """Breadth-first walk: (url, parent_url, depth, path) for every URL
    reachable from ``root_url``; each URL once, with its first discoverer.

    Cycles and shared children are harmless: a URL already visited is never
    re-entered.  The loop runs one level per iteration and ends when a level
    discovers nothing, which the visited set makes certain.
    """
    # the links are read once per level: materialize them once
    edges = reliable_checkpoint(links.select("parent_url", "child_url", "ordinal"))
    ordinal_type = edges.schema["ordinal"].dataType
    visited = spark.range(1).select(
        F.lit(root_url).alias("url"), F.lit(None).cast("string").alias("parent_url"),
        F.lit(0).alias("depth"), F.array().cast(T.ArrayType(ordinal_type)).alias("path"))
    frontier = visited
    for level in count(1):
        cand = (frontier.join(edges, frontier.url == edges.parent_url)
                .select(F.col("child_url").alias("url"), frontier.url.alias("parent_url"),
                        (frontier.depth + 1).alias("depth"),
                        F.concat(frontier.path, F.array(F.col("ordinal"))).alias("path")))
        cand = cand.join(visited.select("url"), "url", "left_anti")
        first = Window.partitionBy("url").orderBy("path", "parent_url")
        new = (cand.withColumn("_rn", F.row_number().over(first))
               .where("_rn = 1").drop("_rn"))
        new = reliable_checkpoint(new)
        if new.isEmpty():
            return visited
        visited = visited.unionByName(new)
        if level % VISITED_CHECKPOINT_EVERY == 0:
            visited = reliable_checkpoint(visited)
        frontier = new


#: Levels that a recursive query may have.
MAX_LEVELS = 1000


def walk_recursive(spark: SparkSession, links: DataFrame, root_url: str) -> DataFrame:
    """``walk`` as one recursive query, for trees and other acyclic links.

    The recursion carries depth and path; a URL that several parents list is
    reached once by each path, and the first discoverer in queue order is kept.  Work
    grows with the number of paths, and a cycle would never end: the query fails
    after ``MAX_LEVELS`` levels.  ``walk`` has neither limit.
    """
    # every level joins the links: parse them once
    links = reliable_checkpoint(links.select("parent_url", "child_url", "ordinal"))
    ordinal = links.schema["ordinal"].dataType.simpleString()
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        reached = reliable_checkpoint(spark.sql(f"""
            WITH RECURSIVE reached(url, parent_url, depth, path) MAX RECURSION LEVEL {MAX_LEVELS} AS (
              SELECT :root AS url, CAST(NULL AS STRING) AS parent_url, 0 AS depth, CAST(array() AS ARRAY<{ordinal}>) AS path
              UNION ALL
              SELECT l.child_url, r.url, r.depth + 1, array_append(r.path, l.ordinal)
              FROM reached r JOIN {{links}} l ON l.parent_url = r.url)
            SELECT * FROM reached""", args={"root": root_url}, links=links))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    first = Window.partitionBy("url").orderBy("depth", "path", "parent_url")
    return reached.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def flatten(spark: SparkSession, entities: DataFrame, links: DataFrame, root_url: str,
            how=walk) -> DataFrame:
    """The stored code table: every reached entity that has a code, with the
    parent code taken from its discoverer's URL (NULL when that segment has
    no letter, e.g. a release year).  how: ``walk`` or ``walk_recursive``."""
    reached = how(spark, links, root_url)
    return (reached.join(entities, "url")
            .where(F.col("code") != "")   # missing and empty codes are not stored
            .select("code", "title", "description",
                    code_from_url("parent_url").alias("parent_code"), "depth"))
