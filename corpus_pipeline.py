"""A training corpus from ``documents``: filter, deduplicate, redact, mix, pack.

Each stage gets all rows that its predecessor kept, as a table that was written
and read again, and calls one operator of ``pluvial.llm``:

1. quality   documents that the quality classifier rejects go
2. simhash   one document of each near-duplicate group stays
3. secrets   secrets are taken out of the texts
4. mixing    documents are taken as often as their source's target asks for
5. packing   the mixed documents are cut into pieces and put into sequences

Null texts count as empty, and the quality classifier decides on them as on all others;
rows without doc_id, repeated rows and very long texts go through like others.  Further
columns of ``documents`` are carried along up to the mixing, whatever their names.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvial.llm import mixing, packing, quality, secrets, simhash
from pluvial.llm.common import shared_path, shipped, table


@shipped
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@shipped
def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


@shipped
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


@shipped
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


@shipped
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The tokenizer, the hashes and the fitted model are beyond SQL; the tests
#: follow every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
