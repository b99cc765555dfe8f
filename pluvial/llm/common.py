"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pluvial
from pluvial.session import checkpoint_root

#: Documents are held out of every fit when crc32(doc_id as text) mod 4 is this.
HELD_OUT_REMAINDER = 2


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per Spark application.

    A deployment that installs it there (or sets PYTHONPATH) does not need
    this; Spark serves the small archive itself, nothing else reads it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_pluvial_shipped", False):
        return
    package = Path(pluvial.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="pluvial-code-")) / "pluvial_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent).as_posix())
    sc.addPyFile(str(archive))
    sc._pluvial_shipped = True


def shipped(run: Callable) -> Callable:
    """``run(spark, ...)`` with the package on the executors."""
    @functools.wraps(run)
    def with_package(spark: SparkSession, *args):
        ship_package(spark)
        return run(spark, *args)
    return with_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the rows it was writing, never the
    steps before.  Returns the table and its path (see ``discard``).
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``materialize`` that no table reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4 = 2; a null id counts as the empty text."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 4 == HELD_OUT_REMAINDER


def hash_fraction(*cols: Column) -> Column:
    """A deterministic number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / float(1 << 30)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """A bounded sample (text, label, doc_id) of the labelled training rows.

    At most about ``per_class`` documents of each class, chosen by a hash of
    doc_id among the rows that are not held out; a smaller class is used
    whole.  Only ids are sampled and broadcast (about 2 * per_class rows,
    whatever the input), so no text is shuffled.  A document with several
    label rows counts once, with its largest label; null labels are unused.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
           .where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    sizes = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    keep = F.lit(False)
    for value, n in sizes.items():
        rate = min(1.0, per_class / n)
        keep = keep | ((F.col("label") == value) & (hash_fraction(F.col("doc_id"), F.lit(7)) < rate))
    chosen = ids.where(keep)
    return (docs.select("doc_id", "text")
            .join(F.broadcast(chosen), "doc_id", "inner")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label"))


def plain_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts empty; other columns never reach an operator."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
