"""Source divergence audit: which sources of a language use its terms unlike the
others, and by which terms.

Terms are runs of ASCII letters and characters beyond ASCII, with only A-Z
lower-cased.  A language keeps the terms that stand in at least ``LEAST_DOCS`` of
its documents, V of them.  A group (lang, source), or the language itself, gives a
kept term ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, N its occurrences of all
kept terms; two such numbers differ by ``f = floor((p - q)^2 / (p + q))``.  All
arithmetic is on integers.

Part ``term``, a group's ten most divergent terms above its language's rate, goes
by a dominance skyband.  f does not fall when the group's count rises or the
language's falls, and ties go to the earlier term (UTF-8); so a term that ten
others dominate in group count, language count and UTF-8 order is not among the
ten.  Every partition keeps the terms of each group that fewer than ten dominate,
skybands are merged in two rounds, and only what is left is ranked by f.

Part ``pair``, f summed over all kept terms for each two sources of a language,
has a row for each ordered pair by definition.  Terms are cut into buckets and
sources into blocks of about ``SOURCE_BLOCK``; a task holds one bucket for two
blocks and sends on a sum for each pair, never a row for each pair and term.
Terms that neither block has are counted, not listed.

Null text, lang and source are ''.  Empty texts and texts without terms make
their group occur.  A language with one source has no pairs; one that keeps no
term has pairs of value 0.  Long texts are read in parts cut between terms.
Documents are rows: repeated rows and repeated doc_ids count each.  Ties go to the
earlier item.  An empty table gives an empty result.  Other columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvial.llm.common import materialize, table

LEAST_DOCS = 10
TOP = 10
SOURCE_BLOCK = 256
#: Rows of (term, source) that one task of the pair part takes, about.
BUCKET_ROWS = 1 << 18
#: Distinct terms that a task counts before it sends them on, and bytes read at once.
HELD_TERMS = 200_000
PART = 1 << 20
#: Skybands of a group are merged in this many parts first.
MERGE_PARTS = 32

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def term_parts(text: str) -> Iterator[list[bytes]]:
    """The terms of a text as UTF-8, in lists of bounded size."""
    data, at = text.encode("utf-8").lower(), 0     # bytes.lower changes A-Z only
    while len(data) - at > PART:
        gap = _GAP.search(data, at + PART)
        if gap is None:
            break
        yield _TERM.findall(data[at:gap.start()])
        at = gap.start()
    yield _TERM.findall(data[at:])


_COUNTED = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), combined within a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for lo in range(0, len(terms), 1 << 16):
                part = terms[lo:lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part)), pa.array([source] * len(part)),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array(list(map(n.__getitem__, part)), pa.int64()),
                    pa.array(list(map(docs.__getitem__, part)), pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in term_parts(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from rows()
    yield from rows()


def rate(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exactly; null if nothing is kept."""
    top = (count + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.when(kept > 0, F.lit(1) + F.call_function("div", top, (total + 2 * kept).cast("decimal(20,0)")))


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def counted_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, source, n, lang_n) of the kept terms that a group holds.

    One exchange, by (lang, term): sums of groups and of languages are taken
    within its partitions.
    """
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("lang", "source", "text")))
    of_term = Window.partitionBy("lang", "term")
    return (plain.mapInArrow(_count, _COUNTED).repartition("lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .select("lang", "term", "source", "n", F.sum("n").over(of_term).alias("lang_n"),
                    F.sum("docs").over(of_term).alias("lang_docs"))
            .where(F.col("lang_docs") >= least_docs).drop("lang_docs"))


def _group_totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for each occurring (lang, source): totals, kept terms, table sizes."""
    occurring = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                              for c in ("lang", "source"))).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells"))
    kept = (counts.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
            .groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")))
    groups = (occurring.join(own, ["lang", "source"], "left").join(kept, "lang", "left")
              .na.fill(0, ["total", "cells", "kept", "lang_total"]))
    size = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("cells").alias("lang_cells"))
    return groups.join(size, "lang")


# --- part "term" -------------------------------------------------------------

def skyband(own: np.ndarray, lang: np.ndarray, k: int, block: int = 256) -> np.ndarray:
    """Marks of the terms that fewer than ``k`` others dominate.

    Terms come in UTF-8 order; an earlier one with at least the group count and
    at most the language count dominates.  A term's dominators outside the
    skyband have k dominators inside it, so counting inside it is enough.
    """
    keep = np.zeros(len(own), bool)
    band_own, band_lang = np.empty(0, np.int64), np.empty(0, np.int64)
    for lo in range(0, len(own), block):
        a, b = own[lo:lo + block], lang[lo:lo + block]
        before = ((band_own[None, :] >= a[:, None]) & (band_lang[None, :] <= b[:, None])).sum(axis=1)
        inside = (a[None, :] >= a[:, None]) & (b[None, :] <= b[:, None])
        before += np.tril(inside, -1).sum(axis=1)
        new = before < k
        keep[lo:lo + block] = new
        band_own, band_lang = np.append(band_own, a[new]), np.append(band_lang, b[new])
    return keep


def _band_of(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    pdf = pdf.sort_values("term", kind="stable")
    return pdf[skyband(pdf["n"].to_numpy(), pdf["lang_n"].to_numpy(), k)]


def top_terms(rated: DataFrame, k: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): each group's k terms of the largest f."""
    schema = "part int, lang string, source string, term string, n long, lang_n long, p long, q long"

    def bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, pd.DataFrame] = {}
        for pdf in frames:
            for group, own in pdf.groupby(["lang", "source"], sort=False):
                if group in held:
                    own = pd.concat([held[group], own])
                held[group] = _band_of(own, k)
            if sum(map(len, held.values())) > HELD_TERMS:    # many groups: merged later
                yield pd.concat(held.values())
                held.clear()
        if held:
            yield pd.concat(held.values())

    found = (rated.where(F.col("p") > F.col("q"))
             .withColumn("part", F.spark_partition_id() % MERGE_PARTS)
             .select("part", "lang", "source", "term", "n", "lang_n", "p", "q")
             .mapInPandas(bands, schema))
    for key in (["lang", "source", "part"], ["lang", "source"]):
        found = found.groupBy(*key).applyInPandas(lambda pdf: _band_of(pdf, k), schema)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (found.select("lang", "source", F.col("term").alias("item"),
                         difference(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


# --- part "pair" -------------------------------------------------------------

_PAIR_ROWS = "lang string, source string, item string, value long, seen long, none long, kept long"


def _pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of f over a bucket's terms for each two sources of two blocks."""
    head, rows = pdf[pdf["term"].isna()], pdf[pdf["term"].notna()]
    sources = pd.Index(head["source"])
    absent, block = head["p"].to_numpy(np.int64), head["block"].to_numpy()
    left = np.flatnonzero(block == pdf["i"].iloc[0])
    right = np.flatnonzero(block == pdf["j"].iloc[0])
    term, names = pd.factorize(rows["term"])
    of, p = sources.get_indexer(rows["source"]), rows["p"].to_numpy(np.int64)
    order = np.argsort(term, kind="stable")
    term, of, p = term[order], of[order], p[order]
    total = np.zeros((len(left), len(right)), np.int64)
    step = max(1, (1 << 20) // max(1, len(sources)))
    for lo in range(0, len(names), step):
        here = slice(np.searchsorted(term, lo), np.searchsorted(term, lo + step))
        m = np.tile(absent, (min(step, len(names) - lo), 1))
        m[term[here] - lo, of[here]] = p[here]
        to = m[:, right]
        for g in range(len(left)):
            own = m[:, left[g], None]
            gap = own - to
            total[g] += (gap * gap // (own + to)).sum(axis=0)
    gap = absent[left][:, None] - absent[right][None, :]
    none = gap * gap // (absent[left][:, None] + absent[right][None, :])
    names_of = sources.to_numpy()
    out = pd.DataFrame({
        "lang": pdf["lang"].iloc[0], "source": np.repeat(names_of[left], len(right)),
        "item": np.tile(names_of[right], len(left)), "value": total.ravel(),
        "seen": len(names), "none": none.ravel(), "kept": pdf["kept"].iloc[0]})
    if pdf["i"].iloc[0] == pdf["j"].iloc[0]:
        return out[out["source"] != out["item"]]
    return pd.concat([out, out.rename(columns={"source": "item", "item": "source"})[out.columns]])


def pair_sums(rated: DataFrame, groups: DataFrame, source_block: int = SOURCE_BLOCK,
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(lang, source, item, value, rank) of each two sources of a language."""
    blocks = F.ceil(F.col("sources") / source_block)
    buckets = 1 + F.call_function("div", F.col("lang_cells"), F.lit(bucket_rows))
    sized = groups.where(F.col("sources") > 1).select(
        "lang", "source", "kept", F.coalesce(rate(F.lit(0), F.col("total"), F.col("kept")), F.lit(1)).alias("absent"),
        blocks.alias("blocks"), buckets.alias("buckets"),
        F.pmod(F.xxhash64("source"), blocks).alias("block"))
    head = sized.select("lang", "source", "kept", "blocks", "block", F.lit(None).cast("string").alias("term"),
                        F.col("absent").alias("p"),
                        F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    rows = rated.select("lang", "source", "term", "p").join(sized, ["lang", "source"]).select(
        "lang", "source", "kept", "blocks", "block", "term", "p",
        F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"))
    met = (head.unionByName(rows)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
           .drop("blocks", "other"))
    sums = (met.groupBy("lang", "bucket", "i", "j").applyInPandas(_pair_sums, _PAIR_ROWS)
            .groupBy("lang", "source", "item")
            .agg((F.sum("value") + (F.max("kept") - F.sum("seen")) * F.max("none")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, k: int = TOP,
          source_block: int = SOURCE_BLOCK, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every occurring group."""
    counts, _ = materialize(counted_terms(docs, least_docs), "divergence-counts")
    groups, _ = materialize(_group_totals(docs, counts), "divergence-groups")
    rated = counts.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"]).select(
        "lang", "source", "term", "n", "lang_n",
        rate(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        rate(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pair_sums(rated, groups, source_block, bucket_rows).withColumn("part", F.lit("pair"))
    terms = top_terms(rated, k).withColumn("part", F.lit("term"))
    return pairs.select(columns).unionByName(terms.select(columns))


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row_id, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words
  GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
lang_size AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
counted AS (
  SELECT w.lang, w.source, w.term, count(*) AS n
  FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (
  SELECT d.lang, d.source, coalesce(c.total, 0) AS total, coalesce(s.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) d
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL) c USING (lang, source)
  LEFT JOIN lang_size s USING (lang)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS BIGINT) AS p
  FROM grp g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
q AS (
  SELECT k.lang, k.term, CAST(1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (s.total + 2 * s.v) AS BIGINT) AS q
  FROM kept k JOIN lang_size s USING (lang)),
pair_sum AS (
  SELECT a.lang, a.source, b.source AS item,
         sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sum s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item,
         CAST((p.p - q.q) * (p.p - q.q) // (p.p + q.q) AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
                                    ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
