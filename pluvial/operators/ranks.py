"""Average ranks (ties share the mean rank) computed without a global window.

A plain ``rank() OVER (ORDER BY x)`` sends every row to one task.  Here:

1. count rows per (group, value)                         - map-side combined
2. range-partition those counts by (group, value)        - balanced by sampling
3. running count inside each range partition            - one task per range
4. per-partition totals -> offsets of each partition     - one row per partition
5. rank = offset + rows before within the partition + (count + 1) / 2

Step 4 works on as many rows as there are partitions, so nothing grows with
the data in a single task.  The counted values are checkpointed once so the
partition ids of steps 3 and 4 refer to the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvial.operators.stats import pearson, student_t_p
from pluvial.session import reliable_checkpoint


def average_ranks(df: DataFrame, value: str, group: Sequence[str] = (),
                  partitions: int | None = None) -> DataFrame:
    """(group..., value, rank) for every distinct non-NULL value."""
    group = list(group)
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.where(F.col(value).isNotNull()).groupBy(*group, value)
              .agg(F.count(F.lit(1)).alias("_n"))
              .repartitionByRange(n_parts, *group, value)
              .withColumn("_part", F.spark_partition_id()))
    counts = reliable_checkpoint(counts)
    inside = Window.partitionBy("_part", *group).orderBy(value) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = counts.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    totals = counts.groupBy(*group, "_part").agg(F.sum("_n").alias("_total"))
    across = Window.partitionBy(*group).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(across), F.lit(0)))
    return (local.join(offsets.select(*group, "_part", "_offset"), [*group, "_part"])
            .select(*group, value,
                    (F.col("_offset") + F.col("_before") + (F.col("_n") + 1) / 2.0)
                    .alias("rank")))


def spearman(long: DataFrame, group: str, x: str, y: str, digits: int = 6) -> DataFrame:
    """Spearman's rho per group: Pearson correlation of average ranks over
    the pairs where both values are present, with its two-sided p-value by Student's t."""
    # both rank passes and the final join read the pairs: write them once
    pairs = reliable_checkpoint(
        long.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(group, x, y))
    rx = average_ranks(pairs, x, [group]).withColumnRenamed("rank", "_rx")
    ry = average_ranks(pairs, y, [group]).withColumnRenamed("rank", "_ry")
    ranked = pairs.join(rx, [group, x]).join(ry, [group, y])
    rho = ranked.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.regr_sxx("_ry", "_rx").alias("_sxx"),
                                    F.regr_syy("_ry", "_rx").alias("_syy"), F.regr_sxy("_ry", "_rx").alias("_sxy")) \
        .withColumn("rho", pearson(F.col("n"), F.col("_sxx"), F.col("_syy"), F.col("_sxy")))
    p_value, log10_p = student_t_p(F.col("rho"), F.col("n"))
    return rho.select(group, "n", F.round("rho", digits).alias("spearman_rho"),
                      F.round(p_value, digits).alias("p_value"), F.round(log10_p, digits).alias("log10_p"))


def number_rows(df: DataFrame, order: Sequence[str], column: str, after: int = 0,
                partitions: int | None = None) -> DataFrame:
    """``df`` with ``column`` = after + 1, after + 2, ... in the order of ``order``.

    Numbers are dense and no two rows share one.  As above, rows are numbered
    inside range partitions, and a partition's offset is the prefix sum of the
    sizes of those before it: one row per partition, whatever the data.
    ``order`` should name a row; rows it cannot tell apart are numbered in any order.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = reliable_checkpoint(df.repartitionByRange(n_parts, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(after)).alias("_offset"))
    return (placed.withColumn("_nth", F.row_number().over(inside)).join(offsets, "_part")
            .withColumn(column, F.col("_offset") + F.col("_nth"))
            .select(*df.columns, column))
