"""Every registered query: name -> callable(spark, folder) -> DataFrame.

Each callable derives the raw layer from the given tables of ``folder`` and
builds the model it names; nothing is collected.  ``pluvial.oracle`` holds an
independent SQL text for every name that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvial.plans import analytics as K
from pluvial.plans import checks as DQ
from pluvial.plans.store import RawStore
from pluvial.plans.warehouse import Warehouse
from pluvial.session import apply_conf
from pluvial.sources import weather as W
from pluvial.sources import derived as D
from pluvial.sources.derived import RawLayer
from pluvial.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    apply_conf(spark)
    return Warehouse.from_folder(spark, sf_dir)


def _model(name: str, drop: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(_wh(spark, sf_dir), name)
        return df.drop(*drop) if drop else df
    run.__name__ = name
    return run


def _numbered(name: str) -> Query:
    """A weather model over stored rows, with their surrogate ids."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        raw = RawLayer(spark, sf_dir)
        return getattr(Warehouse(SimpleNamespace(weather=raw.numbered_weather)), name)
    run.__name__ = name
    return run


def fct_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the mart job builds it: conditions are landed, hot visits found
    in what landed, and every table is derived once."""
    apply_conf(spark)
    raw = RawLayer(spark, sf_dir)
    return Warehouse(SimpleNamespace(
        patients=raw.patients, encounters=raw.encounters, conditions=raw.landed().conditions,
        weather=raw.weather)).balanced_fact()


def _panel(wh: Warehouse) -> DataFrame:
    return K.region_panel(wh.stg_patients, wh.stg_encounters, wh.stg_conditions, wh.stg_weather)


def k_pain_patients_by_region(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.pain_patients_by_region(wh.stg_patients, wh.stg_conditions)


def k_rainy_pain_patients_by_region(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.rainy_pain_patients_by_region(wh.fct_encounters, wh.stg_patients)


PERIOD = ("1995-01-01", "1996-12-31")


def k_rainy_pain_patients_period(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    first, last = (F.lit(d).cast("date") for d in PERIOD)
    return K.rainy_pain_patients_by_region(wh.fct_encounters, wh.stg_patients, first, last)


def k_rainy_pain_patients_marts(spark, sf_dir):
    """The period KPI from written marts; only the period's months are read."""
    from pluvial.session import scratch_path

    wh = _wh(spark, sf_dir)
    written = Warehouse.from_marts(spark, wh.raw, wh.materialize(scratch_path(spark, "marts")))
    first, last = (F.lit(d).cast("date") for d in PERIOD)
    return K.rainy_pain_patients_by_region(written.fct_encounters, written.stg_patients, first, last)


def k_pain_visits_by_season_rain(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.pain_visits_by_season_and_rain(wh.fct_encounters, wh.dim_dates, wh.dim_weather)


def k_visiting_patients_period(spark, sf_dir):
    """F6 at scale: a period's distinct patients per region from daily sketches, beside
    their exact number; ``close`` says whether the estimate is within its bound."""
    wh = _wh(spark, sf_dir)
    first, last = (F.lit(d).cast("date") for d in PERIOD)
    daily = K.visit_sketches(wh.stg_encounters, wh.stg_patients)
    return K.period_patients(daily, wh.stg_encounters, wh.stg_patients, first, last)


def k_rainy_day_share(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.rainy_day_share(K.fact_weather_region_day(wh.stg_patients, wh.stg_weather))


def k_top_diagnoses_by_region(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.top_diagnoses_by_region(wh.stg_patients, wh.stg_conditions, k=3)


def k_fact_diagnosis_region(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.fact_diagnosis_region(wh.stg_patients, wh.stg_conditions)


def k_fact_weather_region_day(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.fact_weather_region_day(wh.stg_patients, wh.stg_weather)


def k_fact_pain_weather_analysis(spark, sf_dir):
    return _panel(_wh(spark, sf_dir))


def k_rain_effect(spark, sf_dir):
    return K.rain_effect(_panel(_wh(spark, sf_dir)))


def k_weather_correlation(spark, sf_dir):
    return K.weather_correlation(_panel(_wh(spark, sf_dir)))


def k_weather_spearman(spark, sf_dir):
    return K.weather_spearman(_panel(_wh(spark, sf_dir)))


def k_icd_validation(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.icd_validation(wh.stg_conditions, wh.stg_icd_codes)


def k_icd_validation_mapped(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.icd_validation(wh.stg_conditions, wh.stg_icd_codes, D.code_mapping(Tables(spark, sf_dir)))


def k_dim_region(spark, sf_dir):
    return K.dim_region(_wh(spark, sf_dir).stg_patients)


def k_dim_diagnosis(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.dim_diagnosis(wh.stg_conditions, wh.stg_icd_codes)


def k_region_day_keys(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return K.region_day_keys(wh.int_encounters_weather, wh.stg_patients)


def weather_request_plan(spark, sf_dir):
    apply_conf(spark)
    raw = RawLayer(spark, sf_dir)
    return W.request_plan(raw.patients, raw.encounters)


def weather_coverage_gaps(spark, sf_dir):
    apply_conf(spark)
    raw = RawLayer(spark, sf_dir)
    return W.coverage_gaps(W.request_plan(raw.patients, raw.encounters), raw.weather)


def weather_gaps_left_out(spark, sf_dir):
    """B7 over observations of which one nation's never landed."""
    apply_conf(spark)
    raw = RawLayer(spark, sf_dir)
    landed = W.clean_observations(D.gappy_observations(raw.tables))
    return W.coverage_gaps(W.request_plan(raw.patients, raw.encounters), landed)


def weather_clean_missing(spark, sf_dir):
    """A12 + D4 + S19 over observations with NaN, NULL and all-missing days."""
    apply_conf(spark)
    return W.clean_observations(D.gappy_observations(Tables(spark, sf_dir)))


def bundle_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 over spoiled bundles: rejected bundles by reason, and the resources of
    the readable ones by type."""
    from pluvial.session import scratch_path
    from pluvial.sources import bundles as B

    apply_conf(spark)
    base = scratch_path(spark, "spoiled")
    D.spoiled_bundles(Tables(spark, sf_dir)).write.text(base)
    ing = B.Ingest(spark, base, layout="lines", glob="*.txt", scratch=scratch_path(spark, "spoiled-parsed"))
    return (B.rejects(ing.rejected).select(F.lit("rejected").alias("outcome"), F.col("reason").alias("what"))
            .unionByName(ing.good.select(F.lit("read").alias("outcome"), F.col("resource_type").alias("what")))
            .groupBy("outcome", "what").agg(F.count(F.lit(1)).alias("n")))


def _raw(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return fn(Tables(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


_BUNDLE_KEYS = {"patients": "id", "encounters": "encounter_id", "conditions": "condition_id"}


def _bundle(kind: str) -> Query:
    """Round trip: land the raw rows as bundles, ingest them back (scan,
    route, parse, quarantine) and load with first-wins into an empty table."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from pluvial.operators.upsert import first_wins
        from pluvial.session import scratch_path
        from pluvial.sources import bundles as B

        apply_conf(spark)
        raw = RawLayer(spark, sf_dir)
        out = B.write_bundles(raw.patients, raw.encounters, raw.conditions,
                              scratch_path(spark, "bundles"), compression="gzip")
        table = getattr(B.Ingest(spark, out, layout="lines", glob="*.txt.gz"), kind)
        return B.without_lineage(first_wins(table, [_BUNDLE_KEYS[kind]], B.LINEAGE))
    run.__name__ = f"bundle_{kind}"
    return run


def stream_weather_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: observations land as several files; an availableNow stream
    upserts them batch by batch into the raw weather table."""
    from pluvial.session import scratch_path
    from pluvial.streaming import landing as L

    apply_conf(spark)
    base = scratch_path(spark, "weather-stream")
    store, landing = RawStore(spark, f"{base}/store"), f"{base}/landing"
    D.weather_observations(Tables(spark, sf_dir)).write.parquet(landing)
    L.run_to_end(L.land_weather_stream(store, landing, f"{base}/checkpoint"))
    return store.table("weather").drop("loaded_at")


def stream_bundle_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: bundles land as several JSON-lines files; an availableNow stream
    parses, quarantines and loads patients, encounters, then conditions."""
    from pluvial.session import scratch_path
    from pluvial.sources import bundles as B
    from pluvial.streaming import landing as L

    apply_conf(spark)
    raw = RawLayer(spark, sf_dir)
    base = scratch_path(spark, "bundle-stream")
    store, landing = RawStore(spark, f"{base}/store"), f"{base}/landing"
    B.write_bundles(raw.patients, raw.encounters, raw.conditions, landing, compression="gzip")
    L.run_to_end(L.land_bundle_stream(store, landing, f"{base}/checkpoint", glob="*.txt.gz"))
    return store.table("conditions").drop("loaded_at")


def stream_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 + B3 over bundles with planted faults: some patients never land, some
    visits name no patient.  What the gate rejects, with the reason."""
    from pluvial.session import scratch_path
    from pluvial.sources import bundles as B
    from pluvial.streaming import landing as L

    apply_conf(spark)
    raw = D.with_orphans(RawLayer(spark, sf_dir))
    base = scratch_path(spark, "orphan-stream")
    store, landing = RawStore(spark, f"{base}/store"), f"{base}/landing"
    B.write_bundles(raw.patients, raw.encounters, raw.conditions, landing, compression="gzip")
    L.run_to_end(L.land_bundle_stream(store, landing, f"{base}/checkpoint", glob="*.txt.gz"))
    key = F.coalesce(F.get_json_object("row", "$.condition_id"), F.get_json_object("row", "$.encounter_id"))
    return store.table("rejected_rows").select("table_name", "reason", key.alias("id"))


def store_reload_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 over the raw store: conditions of three loads, folded into one folder
    between the second and the third, which brings every line again."""
    from pluvial.plans.store import Load
    from pluvial.session import scratch_path

    apply_conf(spark)
    raw = RawLayer(spark, sf_dir)
    store = RawStore(spark, scratch_path(spark, "store"))
    batch, shipped = D.condition_batch(raw.tables), F.col("_o_shipdate")
    day = [F.lit(d).cast("timestamp_ntz") for d in ("1995-01-01", D.FIRST_LOAD_BEFORE)]
    for version, rows in (("1", batch.where(shipped < day[0])), ("2", batch.where(shipped < day[1])), ("3", batch)):
        load = Load(store, version)
        try:
            if version == "1":
                load.add("patients", raw.patients, ["id"])
                load.add("encounters", raw.encounters, ["encounter_id"])
            load.add("conditions", rows, D.CONDITION_ORDER)
            load.commit()
        finally:
            load.close()
        if version == "2":
            store.compact("conditions")
    return store.table("conditions").drop("loaded_at")


def _dq(fn) -> Query:
    """Checks run over the landed raw tables (derived once, then read back)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return fn(RawLayer(spark, sf_dir).landed())
    run.__name__ = fn.__name__
    return run


def dq_damaged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The DQ suite over raw tables with planted faults of every kind."""
    apply_conf(spark)
    return DQ.dq_report(D.damaged(RawLayer(spark, sf_dir).landed()))


QUERIES: dict[str, Query] = {
    # staging
    "stg_patients": _model("stg_patients"),
    "stg_encounters": _model("stg_encounters"),
    "stg_conditions": _model("stg_conditions"),
    "stg_weather": _numbered("stg_weather"),
    "stg_icd_codes": _model("stg_icd_codes"),
    # intermediate
    "int_patient_conditions": _model("int_patient_conditions"),
    "int_encounters_weather": _model("int_encounters_weather"),
    # marts
    "dim_patients": _model("dim_patients"),
    "dim_dates": _model("dim_dates"),
    "dim_conditions": _model("dim_conditions"),
    "dim_weather": _numbered("dim_weather"),
    "fct_encounters": fct_encounters,
    # KPIs and gold tables
    "k_pain_patients_by_region": k_pain_patients_by_region,
    "k_rainy_pain_patients_by_region": k_rainy_pain_patients_by_region,
    "k_rainy_pain_patients_period": k_rainy_pain_patients_period,
    "k_rainy_pain_patients_marts": k_rainy_pain_patients_marts,
    "k_pain_visits_by_season_rain": k_pain_visits_by_season_rain,
    "k_visiting_patients_period": k_visiting_patients_period,
    "k_rainy_day_share": k_rainy_day_share,
    "k_top_diagnoses_by_region": k_top_diagnoses_by_region,
    "k_fact_diagnosis_region": k_fact_diagnosis_region,
    "k_fact_weather_region_day": k_fact_weather_region_day,
    "k_fact_pain_weather_analysis": k_fact_pain_weather_analysis,
    "k_rain_effect": k_rain_effect,
    "k_weather_correlation": k_weather_correlation,
    "k_weather_spearman": k_weather_spearman,
    "k_icd_validation": k_icd_validation,
    "k_icd_validation_mapped": k_icd_validation_mapped,
    "k_dim_region": k_dim_region,
    "k_dim_diagnosis": k_dim_diagnosis,
    "k_region_day_keys": k_region_day_keys,
    # sources
    "weather_request_plan": weather_request_plan,
    "weather_coverage_gaps": weather_coverage_gaps,
    "weather_gaps_left_out": weather_gaps_left_out,
    "weather_clean_missing": weather_clean_missing,
    # upserts
    "upsert_ignore": _raw(D.conditions_after_reload),
    "upsert_replace": _raw(D.icd_after_revision),
    # bundle ingestion (JSON round trip)
    "bundle_patients": _bundle("patients"),
    "bundle_encounters": _bundle("encounters"),
    "bundle_conditions": _bundle("conditions"),
    "bundle_rejected": bundle_rejected,
    # streaming landing
    "stream_weather_landing": stream_weather_landing,
    "stream_bundle_conditions": stream_bundle_conditions,
    "stream_rejected_rows": stream_rejected_rows,
    # the raw store
    "store_reload_compacted": store_reload_compacted,
    # code hierarchy
    "hierarchy_bfs": _raw(D.icd_from_hierarchy),
    "hierarchy_documents": _raw(D.codes_by_walk),
    "hierarchy_recursive": _raw(D.codes_by_recursion),
    # data quality
    "dq_not_null": _dq(DQ.dq_not_null),
    "dq_unique": _dq(DQ.dq_unique),
    "dq_value_range": _dq(DQ.dq_value_range),
    "dq_referential": _dq(DQ.dq_referential),
    "dq_duplicates": _dq(DQ.dq_duplicates),
    "dq_report": _dq(DQ.dq_report),
    "dq_damaged_report": dq_damaged_report,
}
