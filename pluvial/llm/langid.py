"""Language identification by Bayesian evidence fusion.

A text's language is the one with the highest posterior of

    text likelihood x P(declared markup language | language) x prior of the host.

* Text: character n-grams of the words under one multinomial per language,
  counted in Spark over a bounded sample of the labelled documents.  The log
  likelihood is tempered, as neighbouring n-grams tell much the same.
* Declared language (``<html lang>``): how often each value is declared on
  pages of each language, by grouped sums of the texts' posteriors, smoothed.
* Prior: the share of each language on the page's host, smoothed towards its
  registered domain, that towards its suffix, that towards all pages; grouped
  sums again, each page's own part taken out of its counts.

``identify`` works on rows with a url and markup (pages); texts without either
(documents) are judged by the likelihood and the prior of all documents.  The
languages are those of the labels.  Null and empty texts have an even
likelihood, so declaration and host decide; without these the commonest
language wins.  Ties go to the first language by code point.  Rows are judged one by
one, so repeated rows get equal results; an empty table gives an empty result,
and without any labelled text the language is null.  Very long texts and pages are
read whole, in parts.  Other columns than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvial.llm.common import hash_fraction, held_out, materialize, table
from pluvial.llm.extract import best_container, host_of, read_page, text_at
from pluvial.llm.ngrams import Words, chunks

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Training bound: about this many documents of each language.
SAMPLE_PER_LANGUAGE = 1000
TEMPER = 0.25
SMOOTH_COUNT, SMOOTH_HOST, SMOOTH_DECLARED = 0.5, 5.0, 1.0
_HTML_LANG = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})(?![A-Za-z])"


def gram_blocks(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text's words, in blocks; edges are marked."""
    for part in chunks(text):
        words = Words(part)
        # an edge mark alone, and words of marks only, say nothing
        edge = (words.at == 0) | (words.at == words.size[words.word] - 1)
        bare = words.size[words.word] == 2
        for n, (bucket, place) in zip((*ORDERS, 0), words.grams(ORDERS, BUCKETS)):
            if n:
                yield bucket[~(bare[place] | (edge[place] if n == 1 else False))]


@dataclass
class TextModel:
    languages: list[str]
    log_share: np.ndarray     # buckets x languages

    def likelihood(self, text: str) -> np.ndarray:
        """Tempered log likelihood of a text in each language."""
        total = np.zeros(len(self.languages))
        for bucket in gram_blocks(text):
            total += self.log_share[bucket].sum(axis=0)
        return TEMPER * total


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> TextModel:
    """Counts of n-grams per language over a hashed sample, summed in Spark."""
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return TextModel([], np.zeros((BUCKETS, 0)))
    rate = F.coalesce(*[F.when(F.col("lang") == l, F.lit(min(1.0, per_language / n)))
                        for l, n in sizes.items()], F.lit(0.0))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for pdf in frames:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                total = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for bucket in gram_blocks(text):
                    total += np.bincount(bucket, minlength=BUCKETS)
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    counts = (labelled.where(hash_fraction(F.col("doc_id"), F.lit(6)) < rate)
              .select("lang", F.coalesce("text", F.lit("")).alias("text"))
              .mapInPandas(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())   # languages x BUCKETS rows at most
    total = np.full((len(languages), BUCKETS), SMOOTH_COUNT)
    row = {l: i for i, l in enumerate(languages)}
    np.add.at(total, ([row[l] for l in counts.column("lang").to_pylist()],
                      counts.column("bucket").to_numpy()), counts.column("n").to_numpy())
    return TextModel(languages, np.ascontiguousarray(np.log(total / total.sum(axis=1, keepdims=True)).T))


def _likelihood(model: TextModel, column: Column, spark, of_html: bool) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shared.value.likelihood
        for part in parts:
            texts = part
            if of_html:
                pages = [read_page(h) for h in part]
                texts = [text_at(p, best_container(p)[0]) for p in pages]
            yield pd.Series([of(t) for t in texts], dtype=object)

    return score(F.coalesce(column, F.lit("")))


def _softmax(logs: str) -> Column:
    """Posterior array from an array of log weights."""
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def _sums(n: int, post: str = "post") -> list[Column]:
    return [F.sum(F.col(post)[i]).alias(f"s{i}") for i in range(n)]


def _array(n: int, prefix: str = "s") -> Column:
    return F.array(*[F.col(f"{prefix}{i}") for i in range(n)])


def _host_tables(pages: DataFrame, n: int) -> DataFrame:
    """(of, h, dom, suf, whole): sums of the posteriors of a host and of all above it."""
    hosts, _ = materialize(pages.groupBy("host").agg(*_sums(n)).withColumns({
        "suffix": F.element_at(F.split("host", r"\."), -1),
        "domain": F.regexp_extract("host", r"([^.]+\.)?[^.]*$", 0)}), "langid-hosts")
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]
    domains = hosts.groupBy("domain").agg(*again).select(F.col("domain").alias("d"), _array(n).alias("dom"))
    suffixes = hosts.groupBy("suffix").agg(*again).select(F.col("suffix").alias("x"), _array(n).alias("suf"))
    whole = hosts.agg(*again).select(_array(n).alias("whole"))   # one row
    return (hosts.join(domains, F.col("domain") == F.col("d")).join(suffixes, F.col("suffix") == F.col("x"))
            .join(F.broadcast(whole), F.lit(True))
            .select(F.col("host").alias("of"), _array(n).alias("h"), "dom", "suf", "whole"))


def _smoothed(counts: str, below: str) -> Column:
    """Shares of counts without the row's own posterior, smoothed towards ``below``."""
    own = F.zip_with(counts, "post", lambda c, p: F.greatest(c - p, F.lit(0.0)))
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(own, below, lambda c, b: (c + SMOOTH_HOST * b) / (total + SMOOTH_HOST))


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, url, lang, confidence, text_lang, declared) of every page."""
    spark, n = pages.sparkSession, len(model.languages)
    ids = [F.col("page_id"), F.col("url")]
    if not n:
        return pages.select(*ids, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"),
                            F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("declared"))
    html = F.coalesce(F.col("html"), F.lit(""))
    scored, _ = materialize(
        pages.select(*ids, host_of(F.col("url")).alias("host"),
                     F.lower(F.regexp_extract(html, _HTML_LANG, 1))
                     .alias("declared"),
                     _likelihood(model, F.col("html"), spark, True).alias("text"))
        .withColumn("post", _softmax("text")), "langid-scored")
    # P(declared | language): one row per declared value, two or three letters each
    declared = scored.groupBy("declared").agg(*_sums(n))
    totals = scored.agg(*[F.sum(F.col("post")[i]).alias(f"t{i}") for i in range(n)])
    declared, _ = materialize(
        declared.join(F.broadcast(totals), F.lit(True)).select(
            F.col("declared").alias("said"),
            F.array(*[F.log((F.col(f"s{i}") + SMOOTH_DECLARED) / (F.col(f"t{i}") + 10 * SMOOTH_DECLARED))
                      for i in range(n)]).alias("by_declared")), "langid-declared")
    hosts, _ = materialize(_host_tables(scored, n), "langid-priors")
    even = F.array(*[F.lit(1.0 / n)] * n)
    joined = (scored.join(declared, F.col("declared") == F.col("said"))
              .join(hosts, F.col("host") == F.col("of"))
              .withColumn("even", even)
              .withColumn("p0", _smoothed("whole", "even")).withColumn("p1", _smoothed("suf", "p0"))
              .withColumn("p2", _smoothed("dom", "p1")).withColumn("prior", _smoothed("h", "p2"))
              # a page that declares nothing has no evidence of that kind
              .withColumn("said_log", F.when(F.col("declared") == "", F.transform("even", lambda x: x * 0))
                          .otherwise(F.col("by_declared")))
              .withColumn("logs", F.zip_with(F.zip_with("text", "said_log", lambda a, b: a + b), "prior",
                                             lambda a, b: a + F.log(b))))
    return _named(joined, model, "logs", [*ids, F.nullif(F.col("declared"), F.lit("")).alias("declared")])


def identify_texts(docs: DataFrame, model: TextModel) -> DataFrame:
    """(doc_id, lang, confidence, text_lang) of texts without markup or address."""
    spark, n = docs.sparkSession, len(model.languages)
    if not n:
        return docs.select("doc_id", F.lit(None).cast("string").alias("lang"),
                           F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"))
    scored, _ = materialize(
        docs.select("doc_id", _likelihood(model, F.col("text"), spark, False).alias("text"))
        .withColumn("post", _softmax("text")), "langid-texts")
    whole = scored.agg(*_sums(n)).select(_array(n).alias("whole"))   # one row
    joined = (scored.join(F.broadcast(whole), F.lit(True)).withColumn("even", F.array(*[F.lit(1.0 / n)] * n))
              .withColumn("prior", _smoothed("whole", "even"))
              .withColumn("logs", F.zip_with("text", "prior", lambda a, b: a + F.log(b))))
    return _named(joined, model, "logs", [F.col("doc_id")])


def _named(rows: DataFrame, model: TextModel, logs: str, ids: list[Column]) -> DataFrame:
    names = F.array(*[F.lit(l) for l in model.languages])

    def best(column: str) -> Column:
        return F.element_at(names, F.array_position(column, F.array_max(column)).cast("int"))

    return rows.withColumn("final", _softmax(logs)).select(
        *ids, best("final").alias("lang"), F.array_max("final").alias("confidence"), best("text").alias("text_lang"))


def op6_langid(spark, sf_dir: str) -> DataFrame:
    """Every page, and every document as a text without markup and address."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = train(docs)
    of_pages = identify(pages, model).withColumn("doc_id", F.lit(None).cast("long"))
    of_docs = identify_texts(docs, model).withColumns({
        "page_id": F.lit(None).cast("long"), "url": F.lit(None).cast("string"),
        "declared": F.lit(None).cast("string")})
    columns = ["doc_id", "page_id", "url", "lang", "confidence", "text_lang", "declared"]
    return of_pages.select(*columns).unionByName(of_docs.select(*columns))
