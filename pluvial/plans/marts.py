"""Mart models (M8-M12): the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvial.operators.joins import hot_keys, left_join_hot, lookup_join
from pluvial.functions.exprs import (
    age_today, is_weekend, padded_day_name, padded_month_name, rain_category, season,
    temp_category, utc_date,
)


def dim_patients(stg_patients: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per patient.  ``current_age`` is measured at ``as_of``
    (default CURRENT_DATE) and keeps growing after death; coordinates stay
    unrounded, as in the source."""
    return stg_patients.select(
        "patient_id", "gender", "birthdate",
        age_today("birthdate", as_of).alias("current_age"),
        "city", "state", "lat", "lon", "is_deceased", "deceased_datetime", "age_at_death",
    )


def date_spine(first: Column, last: Column) -> Column:
    """Inclusive daily sequence; zero rows when a bound is NULL or first > last."""
    return F.explode(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))))


def dim_dates(stg_encounters: DataFrame) -> DataFrame:
    """Every calendar day from the first visit start to the last visit end.

    Both bounds come from one aggregate (partial per task, one row at the
    end); the spine is as long as the calendar span, not the data.
    """
    bounds = stg_encounters.agg(
        F.min(utc_date("period_start")).alias("d0"),
        F.max(utc_date("period_end")).alias("d1"),
    )
    days = bounds.select(date_spine(F.col("d0"), F.col("d1")).alias("date"))
    d = F.col("date")
    return days.select(
        "date",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        padded_month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        padded_day_name(d).alias("day_of_week"),
        is_weekend(d).alias("is_weekend"),
        season(F.month(d)).alias("season"),
    )


def dim_conditions(stg_conditions: DataFrame, stg_icd_codes: DataFrame) -> DataFrame:
    """One row per diagnosis event, enriched with the ICD-10 entry of its code
    (mostly NULL: the clinical codes are SNOMED).  There are few codes, so a
    shuffle by code would bring the conditions to few tasks: the code table's
    bytes are counted and it is broadcast (``lookup_join``)."""
    c = stg_conditions.select(
        "condition_id", "condition_code", "condition_code_system", "condition_display",
        "clinical_status", "verification_status", "category_code", "is_chronic",
    ).distinct()
    i = stg_icd_codes.select(
        F.col("code").alias("condition_code"),
        F.col("title").alias("icd_title"),
        F.col("description").alias("icd_description"),
        F.col("parent_code").alias("icd_parent_code"),
    )
    return lookup_join(c, i, ["condition_code"]).select(
        "condition_id", "condition_code", "condition_code_system", "condition_display",
        "clinical_status", "verification_status", "category_code", "is_chronic",
        "icd_title", "icd_description", "icd_parent_code",
    )


def dim_weather(stg_weather: DataFrame) -> DataFrame:
    key = ["weather_id"] if "weather_id" in stg_weather.columns else []
    return stg_weather.select(
        *key, "lat", "lon", "weather_date", "tavg", "tmin", "tmax", "prcp", "pres",
        rain_category("prcp").alias("rain_category"),
        temp_category("tavg").alias("temp_category"),
    )


FACT_COLUMNS = (
    "encounter_id", "patient_id", "encounter_date", "condition_id", "class_code",
    "type_display", "reason_code", "reason_display", "lat", "lon", "duration_minutes",
    "tavg", "tmin", "tmax", "prcp", "pres", "condition_code", "condition_display",
    "is_chronic", "clinical_status", "onset_datetime", "abatement_datetime",
)


VISIT_KEY = ("patient_id", "encounter_id")


def hot_visits(stg_conditions: DataFrame) -> list[tuple]:
    """Visits that hold so many conditions that one task should not take them all."""
    return hot_keys(stg_conditions, VISIT_KEY)


def fct_encounters(int_encounters_weather: DataFrame, stg_conditions: DataFrame, hot: Sequence[tuple] = ()) -> DataFrame:
    """Grain: encounter x condition diagnosed at it; an encounter without one
    gives a single row with NULL condition fields.

    ``is_chronic`` is taken from staging, so it stays NULL on rows without a
    condition (recomputing it after the join would turn those rows TRUE).
    Conditions with a NULL encounter link never match; Catalyst drops them
    before the shuffle.  hot: visits with so many conditions that theirs are
    spread over tasks (``hot_visits``).
    """
    c = stg_conditions.select(
        "patient_id", "encounter_id", "condition_id", "condition_code", "condition_display",
        "is_chronic", "clinical_status", "onset_datetime", "abatement_datetime")
    e = int_encounters_weather.withColumn("encounter_date", utc_date("period_start"))
    return left_join_hot(e, c, VISIT_KEY, hot).select(*FACT_COLUMNS)
