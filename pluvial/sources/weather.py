"""Weather landing: request plan (A11), cleaning (A12) and the coverage-gap
report (B7).  The surrogate key (A13) is given when rows are stored
(``ranks.number_rows``): dense, free of collisions, after the stored maximum.

The warehouse fetched one series per rounded patient location over the span
of that location's visits.  Here observations arrive as landed files; the
plan says which (location, date range) pairs should be covered, cleaning is
one distributed projection/filter, and the gap report lists planned
locations that got no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvial.functions.exprs import coord_key, nan_to_null

MEASURES = ("tavg", "tmin", "tmax", "prcp", "pres")
# A day is dropped only if all three of these are missing (tmin/tmax ignored).
KEY_MEASURES = ("tavg", "prcp", "pres")


def request_plan(patients: DataFrame, encounters: DataFrame,
                 as_of: Column | None = None) -> DataFrame:
    """Per rounded (lat, lon): first visit day and last visit end, capped at ``as_of``.

    Only patients with both coordinates count.  Encounters are first reduced
    to one (first start, last end) row per patient (map-side combined), so the
    join moves one row per patient instead of one per visit.
    """
    cap = as_of if as_of is not None else F.current_date()
    spans = encounters.groupBy("patient_id").agg(
        F.min("period_start").alias("first_start"),
        F.max("period_end").alias("last_end"),
    )
    located = patients.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
        .select(F.col("id").alias("patient_id"), coord_key("lat").alias("lat"),
                coord_key("lon").alias("lon"))
    return (
        located.join(spans, "patient_id")
        .groupBy("lat", "lon")
        .agg(F.min("first_start").cast("date").alias("date_from"),
             F.max("last_end").cast("date").alias("max_end"))
        .select("lat", "lon", "date_from", F.least(F.col("max_end"), cap).alias("date_to"))
    )


def clean_observations(obs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """NaN -> NULL, drop days with tavg, prcp and pres all missing.

    ``keep`` names extra columns (e.g. load-order lineage) carried through.
    """
    cleaned = obs.select("lat", "lon", "date", *[nan_to_null(m).alias(m) for m in MEASURES],
                         *keep)
    return cleaned.na.drop(how="all", subset=list(KEY_MEASURES))


def coverage_gaps(plan: DataFrame, weather: DataFrame) -> DataFrame:
    """Planned locations for which no observation landed at all."""
    have = weather.select("lat", "lon").distinct()
    return plan.join(have, ["lat", "lon"], "left_anti")
