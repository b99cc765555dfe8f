"""Typed schemas of the raw layer (the landing tables every model reads)."""

from pyspark.sql import types as T

PATIENTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("birthdate", T.DateType()),
    T.StructField("gender", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("deceased_datetime", T.TimestampType()),
])

ENCOUNTERS = T.StructType([
    T.StructField("encounter_id", T.StringType(), False),
    T.StructField("status", T.StringType()),
    T.StructField("class_code", T.StringType()),
    T.StructField("type_code", T.StringType()),
    T.StructField("type_display", T.StringType()),
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("period_start", T.TimestampType()),
    T.StructField("period_end", T.TimestampType()),
    T.StructField("practitioner_display", T.StringType()),
    T.StructField("location_display", T.StringType()),
    T.StructField("service_provider_display", T.StringType()),
    T.StructField("reason_code", T.StringType()),
    T.StructField("reason_display", T.StringType()),
])

CONDITIONS = T.StructType([
    T.StructField("condition_id", T.StringType(), False),
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("encounter_id", T.StringType()),
    T.StructField("clinical_status", T.StringType()),
    T.StructField("verification_status", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("condition_code", T.StringType()),
    T.StructField("condition_code_system", T.StringType()),
    T.StructField("condition_display", T.StringType()),
    T.StructField("onset_datetime", T.TimestampType()),
    T.StructField("recorded_date", T.DateType()),
    T.StructField("abatement_datetime", T.TimestampType()),
])

WEATHER = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("tavg", T.DoubleType()),
    T.StructField("tmin", T.DoubleType()),
    T.StructField("tmax", T.DoubleType()),
    T.StructField("prcp", T.DoubleType()),
    T.StructField("pres", T.DoubleType()),
])

# Landed daily observations before cleaning (NaN allowed, no surrogate key).
WEATHER_OBSERVATION = T.StructType([
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("tavg", T.DoubleType()),
    T.StructField("tmin", T.DoubleType()),
    T.StructField("tmax", T.DoubleType()),
    T.StructField("prcp", T.DoubleType()),
    T.StructField("pres", T.DoubleType()),
])

ICD_CODES = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("parent_code", T.StringType()),
])

# Natural keys (primary key or UNIQUE constraint) of each raw table.
KEYS = {
    "patients": ["id"],
    "encounters": ["encounter_id"],
    "conditions": ["condition_id"],
    "weather": ["lat", "lon", "date"],
    "icd_codes": ["code"],
}


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
