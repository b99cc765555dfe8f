"""Staging models (M1-M5): one cleaned view per raw table.

Each drops the load stamp, renames keys and adds the derived columns; all
are projections, so Catalyst folds them into whatever reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.functions.exprs import age_years, duration_minutes, utc_date


def stg_patients(patients: DataFrame) -> DataFrame:
    deceased = F.col("deceased_datetime")
    return patients.select(
        F.col("id").alias("patient_id"),
        "birthdate", "gender", "city", "state", "lat", "lon", "deceased_datetime",
        deceased.isNotNull().alias("is_deceased"),
        F.when(deceased.isNotNull(), age_years(utc_date(deceased), "birthdate"))
        .alias("age_at_death"),
    )


def stg_encounters(encounters: DataFrame) -> DataFrame:
    return encounters.select(
        "encounter_id", "patient_id", "status", "class_code", "type_code", "type_display",
        "period_start", "period_end", "practitioner_display", "location_display",
        "service_provider_display", "reason_code", "reason_display",
        duration_minutes("period_start", "period_end").alias("duration_minutes"),
    )


def stg_conditions(conditions: DataFrame) -> DataFrame:
    return conditions.select(
        "condition_id", "patient_id", "encounter_id", "clinical_status",
        "verification_status", "category_code", "condition_code", "condition_code_system",
        "condition_display", "onset_datetime", "recorded_date", "abatement_datetime",
        # "chronic" means only "never resolved" (no abatement date)
        F.col("abatement_datetime").isNull().alias("is_chronic"),
    )


def stg_weather(weather: DataFrame) -> DataFrame:
    """Stored weather has an id; models of measures also take it before it is stored."""
    key = [F.col("id").alias("weather_id")] if "id" in weather.columns else []
    return weather.select(
        *key, "lat", "lon", F.col("date").alias("weather_date"),
        "tavg", "tmin", "tmax", "prcp", "pres",
    )


def stg_icd_codes(icd: DataFrame) -> DataFrame:
    return icd.select("code", "title", "description", "parent_code")
