"""KPI models and documented gold tables (K1-K12).

Definitions (decisions where the warehouse only names the metric):

- region               = (state, city) of the patient
- pain diagnosis       = condition_display ILIKE any of ``PAIN_PATTERNS``
- rainy                = prcp > 0; unknown precipitation counts as neither
- region-day weather   = mean over the region's rounded patient locations
- region-day panel     = every region-day with weather, zero-filled with
                         visits and pain visits (dry, visit-free days count)

Every aggregate is shaped to combine map-side: per-patient partial counts
come before the join to the patient table, and distinct counts become a
group-by on (group, patient) followed by a count, so a region holding a
third of all patients still moves only one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvial.functions.exprs import PAIN_PATTERNS, coord_key, is_pain_diagnosis, utc_date
from pluvial.operators import stats
from pluvial.operators.topk import top_k_per_group

REGION = ("state", "city")
ROUND = 6


def _region_of(stg_patients: DataFrame) -> DataFrame:
    return stg_patients.select("patient_id", *REGION)


def _region_locations(stg_patients: DataFrame) -> DataFrame:
    """Distinct (region, rounded location) pairs of patients with coordinates."""
    return (stg_patients.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .select(*REGION, coord_key("lat").alias("lat"), coord_key("lon").alias("lon"))
            .distinct())


def _pain_keys(stg_conditions: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Distinct (patient, encounter) pairs with a pain diagnosis."""
    return (stg_conditions.where(is_pain_diagnosis("condition_display", patterns))
            .select("patient_id", "encounter_id").distinct())


# K1 ---------------------------------------------------------------------------
def pain_patients_by_region(stg_patients: DataFrame, stg_conditions: DataFrame,
                            patterns: Sequence[str] = PAIN_PATTERNS) -> DataFrame:
    pain = (stg_conditions.where(is_pain_diagnosis("condition_display", patterns))
            .select("patient_id").distinct())
    return (_region_of(stg_patients).join(pain, "patient_id", "left_semi")
            .groupBy(*REGION).agg(F.count(F.lit(1)).alias("pain_patients")))


# K2 ---------------------------------------------------------------------------
def rainy_pain_patients_by_region(fct_encounters: DataFrame, stg_patients: DataFrame,
                                  date_from: Column | None = None,
                                  date_to: Column | None = None,
                                  patterns: Sequence[str] = PAIN_PATTERNS) -> DataFrame:
    """Distinct patients with a pain diagnosis made at a visit on a rainy day
    (optionally inside [date_from, date_to]).  A written fact is partitioned by
    month, so the bounds are put on the month as well."""
    f = fct_encounters.where(is_pain_diagnosis("condition_display", patterns)
                             & (F.col("prcp") > 0))
    by_month = "encounter_month" in f.columns
    if date_from is not None:
        f = f.where(F.col("encounter_date") >= date_from)
        if by_month:
            f = f.where(F.col("encounter_month") >= F.date_format(date_from, "yyyy-MM"))
    if date_to is not None:
        f = f.where(F.col("encounter_date") <= date_to)
        if by_month:
            f = f.where(F.col("encounter_month") <= F.date_format(date_to, "yyyy-MM"))
    patients = f.select("patient_id").distinct()
    return (_region_of(stg_patients).join(patients, "patient_id", "left_semi")
            .groupBy(*REGION).agg(F.count(F.lit(1)).alias("rainy_pain_patients")))


# E8 ---------------------------------------------------------------------------
def pain_visits_by_season_and_rain(fct_encounters: DataFrame, dim_dates: DataFrame,
                                   dim_weather: DataFrame) -> DataFrame:
    """Star join: pain visits per season and rain category (both dimensions
    keep visits they do not know, as 'Unknown')."""
    pain = fct_encounters.where(is_pain_diagnosis("condition_display")).select(
        "encounter_id", "encounter_date", "lat", "lon").distinct()
    d = dim_dates.select(F.col("date").alias("encounter_date"), "season")
    w = dim_weather.select("lat", "lon", F.col("weather_date").alias("encounter_date"), "rain_category")
    known = pain.join(d, "encounter_date", "left").join(w, ["lat", "lon", "encounter_date"], "left")
    return known.groupBy(
        F.coalesce("season", F.lit("Unknown")).alias("season"),
        F.coalesce("rain_category", F.lit("Unknown")).alias("rain_category"),
    ).agg(F.count(F.lit(1)).alias("pain_visits"))


# K10 --------------------------------------------------------------------------
def fact_weather_region_day(stg_patients: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """Weather per region and day: mean over the region's rounded locations."""
    w = stg_weather.select("lat", "lon", "weather_date", "tavg", "tmin", "tmax", "prcp", "pres")
    return (
        _region_locations(stg_patients).join(w, ["lat", "lon"])
        .groupBy(*REGION, "weather_date")
        .agg(
            F.count(F.lit(1)).alias("n_locations"),
            F.round(F.avg("tavg"), ROUND).alias("tavg"),
            F.min("tmin").alias("tmin"),
            F.max("tmax").alias("tmax"),
            F.round(F.avg("prcp"), ROUND).alias("prcp"),
            F.round(F.avg("pres"), ROUND).alias("pres"),
        )
    )


# F6 ---------------------------------------------------------------------------
#: Sketches of 2^12 registers: a standard error of 1.6 %, and a bound of three of them.
SKETCH_LG_K, SKETCH_BOUND = 12, 0.05


def visit_sketches(stg_encounters: DataFrame, stg_patients: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Distinct visiting patients per region and day as mergeable sketches.

    A sketch has at most 2^lg_k registers, however many patients; the patients of
    any period are a merge of its days' sketches, with no second look at the visits.
    """
    days = stg_encounters.select("patient_id", utc_date("period_start").alias("visit_day")).where("visit_day is not null")
    return (days.join(_region_of(stg_patients), "patient_id")
            .groupBy(*REGION, "visit_day").agg(F.hll_sketch_agg("patient_id", lg_k).alias("patients")))


def period_estimate(daily: DataFrame, first: Column, last: Column) -> DataFrame:
    """(region, estimate): distinct patients of a period, from its days' sketches."""
    return (daily.where(F.col("visit_day").between(first, last)).groupBy(*REGION)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("patients")).alias("estimate")))


def period_patients(daily: DataFrame, stg_encounters: DataFrame, stg_patients: DataFrame,
                    first: Column, last: Column) -> DataFrame:
    """(region, patients, close): the exact number, and whether the merged sketches
    come within ``SKETCH_BOUND`` of it."""
    seen = stg_encounters.where(utc_date("period_start").between(first, last)).select("patient_id").distinct()
    exact = (seen.join(_region_of(stg_patients), "patient_id").groupBy(*REGION)
             .agg(F.count(F.lit(1)).alias("patients")))
    gap = F.abs(F.col("estimate") - F.col("patients"))
    return exact.join(period_estimate(daily, first, last), list(REGION), "left").select(
        *REGION, "patients", F.coalesce(gap <= SKETCH_BOUND * F.col("patients"), F.lit(False)).alias("close"))


# K3 ---------------------------------------------------------------------------
def rainy_day_share(region_day_weather: DataFrame) -> DataFrame:
    """Percent of region-days with known precipitation that were rainy.

    Computed from weather x region locations, not from visits: averaging
    over fact rows would weight each day by its number of visits.
    """
    known = F.col("prcp").isNotNull()
    return (
        region_day_weather.groupBy(*REGION).agg(
            F.count(F.when(known, 1)).alias("known_days"),
            F.count(F.when(F.col("prcp") > 0, 1)).alias("rainy_days"),
        )
        .select(*REGION, "known_days", "rainy_days",
                F.round(stats.safe_div(F.lit(100.0) * F.col("rainy_days"), F.col("known_days")),
                        ROUND).alias("rainy_day_pct"))
    )


# K4 ---------------------------------------------------------------------------
def top_diagnoses_by_region(stg_patients: DataFrame, stg_conditions: DataFrame,
                            k: int = 3) -> DataFrame:
    """The k commonest diagnoses (by number of diagnosis events) per region;
    ties broken by display name so the result is deterministic."""
    counts = diagnosis_region_counts(stg_patients, stg_conditions, by_code=False)
    return top_k_per_group(
        counts, list(REGION), [F.desc("n_diagnoses"), F.asc_nulls_last("condition_display")],
        k, rank_col="diagnosis_rank",
    ).select(*REGION, "diagnosis_rank", "condition_display", "n_diagnoses")


# K9 ---------------------------------------------------------------------------
def diagnosis_region_counts(stg_patients: DataFrame, stg_conditions: DataFrame,
                            by_code: bool = True) -> DataFrame:
    """Diagnosis events and distinct patients per region and diagnosis.

    Conditions are first counted per (patient, diagnosis) map-side; after
    the join to the patient's region, distinct patients are the number of
    such groups, so no distinct aggregate is needed.
    """
    diag = ["condition_code", "condition_display"] if by_code else ["condition_display"]
    per_patient = stg_conditions.groupBy("patient_id", *diag) \
        .agg(F.count(F.lit(1)).alias("n"))
    return (per_patient.join(_region_of(stg_patients), "patient_id")
            .groupBy(*REGION, *diag)
            .agg(F.sum("n").alias("n_diagnoses"), F.count(F.lit(1)).alias("n_patients")))


def fact_diagnosis_region(stg_patients: DataFrame, stg_conditions: DataFrame) -> DataFrame:
    return diagnosis_region_counts(stg_patients, stg_conditions, by_code=True)


# K11 ------------------------------------------------------------------------
def visits_region_day(stg_encounters: DataFrame, stg_patients: DataFrame,
                      stg_conditions: DataFrame,
                      patterns: Sequence[str] = PAIN_PATTERNS) -> DataFrame:
    """Visits, visiting patients, pain visits and pain patients per region-day."""
    pain = _pain_keys(stg_conditions, patterns).withColumn("_pain", F.lit(1))
    per_patient_day = (
        stg_encounters.select("encounter_id", "patient_id",
                              utc_date("period_start").alias("weather_date"))
        .join(pain, ["patient_id", "encounter_id"], "left")
        .groupBy("patient_id", "weather_date")
        .agg(F.count(F.lit(1)).alias("n_visits"),
             F.count("_pain").alias("pain_visits"))
    )
    return (
        per_patient_day.join(_region_of(stg_patients), "patient_id")
        .groupBy(*REGION, "weather_date")
        .agg(F.sum("n_visits").alias("n_visits"),
             F.count(F.lit(1)).alias("n_patients"),
             F.sum("pain_visits").alias("pain_visits"),
             F.count(F.when(F.col("pain_visits") > 0, 1)).alias("pain_patients"))
    )


def fact_pain_weather_analysis(region_day_weather: DataFrame,
                               region_day_visits: DataFrame) -> DataFrame:
    """Region-day panel: weather joined with visit counts, zero-filled."""
    v = region_day_visits
    zero = F.lit(0).cast("bigint")
    return (
        region_day_weather.join(v, [*REGION, "weather_date"], "left")
        .select(
            *REGION, "weather_date", "n_locations", "tavg", "tmin", "tmax", "prcp", "pres",
            F.when(F.col("prcp").isNotNull(), F.col("prcp") > 0).alias("is_rainy"),
            F.coalesce("n_visits", zero).alias("n_visits"),
            F.coalesce("n_patients", zero).alias("n_patients"),
            F.coalesce("pain_visits", zero).alias("pain_visits"),
            F.coalesce("pain_patients", zero).alias("pain_patients"),
        )
    )


# K5 ---------------------------------------------------------------------------
def rain_effect(panel: DataFrame) -> DataFrame:
    """2x2 table of region-days (rainy x any pain patient) with the chi-square
    test of independence (1 df), its p-value and the odds ratio."""
    known = panel.where(F.col("is_rainy").isNotNull())
    pain = F.col("pain_patients") > 0
    rainy = F.col("is_rainy")
    cells = known.agg(
        F.count(F.when(rainy & pain, 1)).alias("rainy_pain_days"),
        F.count(F.when(rainy & ~pain, 1)).alias("rainy_no_pain_days"),
        F.count(F.when(~rainy & pain, 1)).alias("dry_pain_days"),
        F.count(F.when(~rainy & ~pain, 1)).alias("dry_no_pain_days"),
    )
    return stats.two_by_two(cells, "rainy_pain_days", "rainy_no_pain_days",
                            "dry_pain_days", "dry_no_pain_days", ROUND)


# K6 ---------------------------------------------------------------------------
WEATHER_FACTORS = ("tavg", "prcp", "pres")


def weather_correlation(panel: DataFrame, target: str = "pain_patients",
                        factors: Sequence[str] = WEATHER_FACTORS) -> DataFrame:
    """Pearson correlation, regression line and t statistic of each weather
    factor against the region-day pain count (one row per factor)."""
    long = panel.select(
        F.col(target).cast("double").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("double").alias("x"))
                            for f in factors])).alias("fx"),
    ).select("fx.factor", "fx.x", "y")
    return stats.pairwise_regression(long, "factor", "x", "y", ROUND)


def weather_spearman(panel: DataFrame, target: str = "pain_patients",
                     factors: Sequence[str] = WEATHER_FACTORS) -> DataFrame:
    """Spearman's rank correlation of each weather factor with the region-day
    pain count (ranks from a distributed prefix sum, see ``operators.ranks``)."""
    from pluvial.operators.ranks import spearman

    long = panel.select(
        F.col(target).cast("double").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("double").alias("x"))
                            for f in factors])).alias("fx"),
    ).select("fx.factor", "fx.x", "y")
    return spearman(long, "factor", "x", "y", ROUND)


# K7 ---------------------------------------------------------------------------
def icd_validation(stg_conditions: DataFrame, stg_icd_codes: DataFrame,
                   mapping: DataFrame | None = None) -> DataFrame:
    """Share of diagnosis events whose code is a known ICD-10 code, per coding system.

    mapping: (from_code, to_code), what other systems' codes stand for.  A code that
    is not known itself counts as known if one it maps to is; mapped events are
    counted apart as well.  A code may map to several: its events count once.
    """
    codes = stg_icd_codes.select(F.col("code").alias("condition_code"),
                                 F.lit(1).alias("_known"))
    # counted per code before the join: what moves is one row per distinct code
    counted = (stg_conditions.groupBy("condition_code_system", "condition_code")
               .agg(F.count(F.lit(1)).alias("_n"))
               .join(codes, "condition_code", "left"))
    matched, mapped = F.col("_known").isNotNull(), []
    if mapping is not None:
        good = (mapping.join(codes, F.col("to_code") == F.col("condition_code")).select("from_code").distinct()
                .withColumn("_mapped", F.lit(1)))
        counted = counted.join(good, F.col("condition_code") == F.col("from_code"), "left")
        through = F.col("_known").isNull() & F.col("_mapped").isNotNull()
        mapped = [F.coalesce(F.sum(F.when(through, F.col("_n"))), F.lit(0)).alias("n_mapped")]
        matched = matched | through
    return (
        counted.groupBy("condition_code_system")
        .agg(F.sum("_n").alias("n_conditions"),
             F.coalesce(F.sum(F.when(matched, F.col("_n"))), F.lit(0)).alias("n_icd_matched"), *mapped)
        .select("condition_code_system", "n_conditions", "n_icd_matched", *(["n_mapped"] if mapped else []),
                F.round(stats.safe_div(F.lit(100.0) * F.col("n_icd_matched"),
                                       F.col("n_conditions")), ROUND).alias("match_pct"))
    )


# K8 ---------------------------------------------------------------------------
def dim_region(stg_patients: DataFrame) -> DataFrame:
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return (stg_patients.groupBy(*REGION)
            .agg(F.count(F.lit(1)).alias("n_patients"),
                 F.count(F.when(located, 1)).alias("n_located"))
            .select(F.concat_ws("/", "state", "city").alias("region_key"), *REGION,
                    "n_patients", "n_located"))


def dim_diagnosis(stg_conditions: DataFrame, stg_icd_codes: DataFrame,
                  patterns: Sequence[str] = PAIN_PATTERNS) -> DataFrame:
    diag = (stg_conditions.groupBy("condition_code", "condition_display", "condition_code_system")
            .agg(F.count(F.lit(1)).alias("n_diagnoses")))
    icd = stg_icd_codes.select(F.col("code").alias("condition_code"),
                               F.col("title").alias("icd_title"),
                               F.col("parent_code").alias("icd_parent_code"))
    return diag.join(icd, "condition_code", "left").select(
        "condition_code", "condition_display", "condition_code_system", "n_diagnoses",
        "icd_title", "icd_parent_code",
        F.coalesce(is_pain_diagnosis("condition_display", patterns), F.lit(False))
        .alias("is_pain"),
    )


# K12 -------------------------------------------------------------------------
def region_day_keys(int_encounters_weather: DataFrame, stg_patients: DataFrame) -> DataFrame:
    """Each visit linked to its region, UTC visit day and matched weather day."""
    return (
        int_encounters_weather.select(
            "encounter_id", "patient_id", "lat", "lon",
            utc_date("period_start").alias("encounter_date"),
            (F.col("tavg").isNotNull() | F.col("prcp").isNotNull() | F.col("pres").isNotNull())
            .alias("has_weather"))
        .join(_region_of(stg_patients), "patient_id")
        .select("encounter_id", "patient_id", *REGION, "lat", "lon", "encounter_date",
                "has_weather")
    )


def region_panel(stg_patients: DataFrame, stg_encounters: DataFrame,
                 stg_conditions: DataFrame, stg_weather: DataFrame,
                 patterns: Sequence[str] = PAIN_PATTERNS) -> DataFrame:
    return fact_pain_weather_analysis(
        fact_weather_region_day(stg_patients, stg_weather),
        visits_region_day(stg_encounters, stg_patients, stg_conditions, patterns),
    )

