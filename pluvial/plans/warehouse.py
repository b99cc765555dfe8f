"""The model graph raw -> staging -> intermediate -> marts as one object.

Staging and intermediate models are views (B5): plain DataFrames that
Catalyst inlines into whatever reads them.  Marts are tables (B6):
``materialize`` writes them in dependency order (B4) so that later jobs read
compact Parquet instead of re-running the joins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from pluvial.plans import intermediate, marts, staging
from pluvial.sources.derived import RawLayer


class Warehouse:
    """Lazily built models over a raw layer.

    ``raw`` needs the attributes ``patients``, ``encounters``, ``conditions``,
    ``weather`` and ``icd_codes`` (DataFrames with the raw schemas).
    """

    def __init__(self, raw, as_of: Column | None = None):
        self.raw = raw
        self.as_of = as_of

    @classmethod
    def from_folder(cls, spark: SparkSession, sf_dir: str, as_of: Column | None = None):
        return cls(RawLayer(spark, sf_dir), as_of=as_of)

    @classmethod
    def from_marts(cls, spark: SparkSession, raw, paths: dict[str, str]):
        """Models whose marts are read from where ``materialize`` wrote them."""
        wh = cls(raw)
        wh.__dict__.update({name: spark.read.parquet(paths[name]) for name in cls.MARTS})
        return wh

    # staging (views)
    @cached_property
    def stg_patients(self) -> DataFrame:
        return staging.stg_patients(self.raw.patients)

    @cached_property
    def stg_encounters(self) -> DataFrame:
        return staging.stg_encounters(self.raw.encounters)

    @cached_property
    def stg_conditions(self) -> DataFrame:
        return staging.stg_conditions(self.raw.conditions)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stg_weather(self.raw.weather)

    @cached_property
    def stg_icd_codes(self) -> DataFrame:
        return staging.stg_icd_codes(self.raw.icd_codes)

    # intermediate (views)
    @cached_property
    def int_patient_conditions(self) -> DataFrame:
        return intermediate.int_patient_conditions(self.stg_patients, self.stg_conditions)

    @cached_property
    def int_encounters_weather(self) -> DataFrame:
        return intermediate.int_encounters_weather(
            self.stg_encounters, self.stg_patients, self.stg_weather)

    # marts (tables)
    @cached_property
    def dim_patients(self) -> DataFrame:
        return marts.dim_patients(self.stg_patients, self.as_of)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return marts.dim_dates(self.stg_encounters)

    @cached_property
    def dim_conditions(self) -> DataFrame:
        return marts.dim_conditions(self.stg_conditions, self.stg_icd_codes)

    @cached_property
    def dim_weather(self) -> DataFrame:
        return marts.dim_weather(self.stg_weather)

    @cached_property
    def fct_encounters(self) -> DataFrame:
        return marts.fct_encounters(self.int_encounters_weather, self.stg_conditions)

    def balanced_fact(self) -> DataFrame:
        """``fct_encounters`` with the conditions of hot visits spread over tasks; their
        keys are looked for now, in one pass over the conditions' key columns."""
        return marts.fct_encounters(self.int_encounters_weather, self.stg_conditions,
                                    marts.hot_visits(self.stg_conditions))

    MARTS = ("dim_patients", "dim_dates", "dim_conditions", "dim_weather", "fct_encounters")

    def materialize(self, out_dir: str, partition_fact_by_month: bool = True) -> dict[str, str]:
        """Write every mart as Parquet under ``out_dir`` (full rebuild, B6).

        The fact is partitioned by visit month: KPIs bounded by dates add the
        months to their filter and so prune files.  A month's rows are brought
        together before the write, and AQE splits months that are too large
        for a task.  Returns name -> path.
        """
        from pyspark.sql import functions as F

        paths = {}
        for name in self.MARTS:
            df = self.balanced_fact() if name == "fct_encounters" else getattr(self, name)
            path = f"{out_dir.rstrip('/')}/{name}"
            writer = df
            if name == "fct_encounters" and partition_fact_by_month:
                writer = df.withColumn("encounter_month",
                                       F.date_format("encounter_date", "yyyy-MM")
                                       ).hint("rebalance", "encounter_month")
                writer.write.mode("overwrite").partitionBy("encounter_month").parquet(path)
            else:
                writer.write.mode("overwrite").parquet(path)
            paths[name] = path
        return paths
