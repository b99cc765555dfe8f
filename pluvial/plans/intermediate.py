"""Intermediate models (M6, M7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.functions.exprs import coord_key, utc_date

WEATHER_MEASURES = ("tavg", "tmin", "tmax", "prcp", "pres")


def int_patient_conditions(stg_patients: DataFrame, stg_conditions: DataFrame) -> DataFrame:
    """Patients left-joined with their conditions (a patient without any stays once)."""
    p = stg_patients.select("patient_id", "gender", "birthdate", "city", "state", "lat",
                            "lon", "is_deceased")
    c = stg_conditions.select(
        "patient_id", "condition_id", "encounter_id", "condition_code",
        "condition_code_system", "condition_display", "clinical_status",
        "verification_status", "category_code", "onset_datetime", "recorded_date",
        "abatement_datetime", "is_chronic")
    return p.join(c, "patient_id", "left")


def int_encounters_weather(stg_encounters: DataFrame, stg_patients: DataFrame,
                           stg_weather: DataFrame) -> DataFrame:
    """One row per encounter with the weather of the visit's UTC day at the
    patient's rounded location (NULL weather when there is none).

    The weather key is typed on both sides (rounded double lat/lon, date), so
    the left join is a plain equi-join.  Weather is unique per key (DQ-gated),
    so the join cannot fan out.  Rows whose patient has no coordinates carry
    NULL keys; AQE's skew handling splits that partition of the left side if
    it grows large, and a small weather side is broadcast at run time instead.
    """
    e = stg_encounters.select(
        "encounter_id", "patient_id", "period_start", "period_end", "duration_minutes",
        "class_code", "type_display", "reason_code", "reason_display")
    p = stg_patients.select("patient_id", coord_key("lat").alias("lat"),
                            coord_key("lon").alias("lon"))
    w = stg_weather.select("lat", "lon", F.col("weather_date").alias("_visit_day"),
                           *WEATHER_MEASURES)
    visits = e.join(p, "patient_id").withColumn("_visit_day", utc_date("period_start"))
    return visits.join(w, ["lat", "lon", "_visit_day"], "left").select(
        "encounter_id", "patient_id", "period_start", "period_end", "duration_minutes",
        "class_code", "type_display", "reason_code", "reason_display", "lat", "lon",
        *WEATHER_MEASURES,
    )
