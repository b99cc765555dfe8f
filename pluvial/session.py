"""Session settings the models rely on, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  UTC makes ``timestamp::date``
# the UTC calendar day, as the warehouse models expect; ANSI keeps bad casts
# loud; AQE re-plans joins (runtime broadcast of small sides, skew splits).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pluvial", extra: dict | None = None) -> SparkSession:
    """A session for tests, the bench and local runs (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as a URI.

    On a cluster the deployment must set it, to a file system that driver and
    executors share; without it this raises.  Only in local mode, where all
    tasks run on the driver's machine, is a private folder made and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="pluvial-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Rows that a task of a counted shuffle takes at least, and at most, about.
TASK_ROWS, MOST_TASK_ROWS = 100_000, 1_100_000


def tasks_for(spark: SparkSession, rows: int, most: int | None = None) -> int:
    """Partitions of a shuffle of so many rows, so that no task takes more than ``most``.

    AQE joins small partitions of the session's number, but never raises it; here that
    holds until tasks would be too large.  ``most`` is wide for wide rows: above 200
    partitions the writing side sorts its rows in memory.
    """
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // (most or MOST_TASK_ROWS)), min(session, -(-rows // TASK_ROWS)))


def reliable_checkpoint(df):
    """Cut lineage by writing ``df`` to the shared checkpoint folder as Parquet and
    reading it back: one copy, with column pruning on every later read."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def set_for(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session, for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the writes that run inside go when a write is done, not when the
    driver's garbage collector gets to them.  For writes, which nothing runs twice."""
    return set_for(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
