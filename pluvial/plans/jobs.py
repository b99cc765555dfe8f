"""Batch jobs in dependency order: land -> check -> build.

- ``load_bundles``   A1-A10 + B1 + B4 + A14 + F5: ingest landed bundles and
                     append their new rows to the raw tables, parents first,
                     with a load stamp and row counts
- ``load_weather``   A12 + A13 + B1 + B7: clean landed observations and append
- ``load_icd``       A15 + A16 + B2 + A14: walk the code hierarchy and replace
- ``check_raw``      DQ1-DQ5 + B3: the constraint gate before any model build
- ``build_marts``    B5 + B6: staging/intermediate as temp views, marts written

``store_bundles``, ``store_weather`` and ``store_icd`` are these loads into a store
(``plans.store``), which keeps the lists of load folders itself; ``build_marts`` reads
from one too.

Without a store, a raw table is a list of load folders.  A load writes its new rows to a folder
of its own, checks them there (B3: keys, NOT NULL, foreign keys) and returns the
longer list; the folders that are already in it are never rewritten.  A failed
load returns no list, so its folder is part of no table, and a retry under the
same version starts it anew.  Code tables are small and get a new version.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from types import SimpleNamespace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pluvial import schemas
from pluvial.operators import quality as Q
from pluvial.operators.ranks import number_rows
from pluvial.operators.upsert import fresh_rows, split_null_keys, upsert_replace
from pluvial.plans import checks
from pluvial.plans.store import LOADED_AT, Load, RawStore, State
from pluvial.plans.warehouse import Warehouse
from pluvial.session import reliable_checkpoint, scratch_path
from pluvial.sources import bundles as B
from pluvial.sources.hierarchy import flatten, links_from_documents, parse_entities
from pluvial.sources.weather import clean_observations, coverage_gaps

log = logging.getLogger(__name__)

def stamp(df: DataFrame) -> DataFrame:
    """A14: the load time of every inserted row."""
    return df.withColumn(LOADED_AT, F.current_timestamp())


def read_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A raw table from its load folders."""
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def _listed(paths: str | Sequence[str] | None) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths or [])


def _write_load(df: DataFrame, raw_dir: str, name: str, version: str,
                loaded: Sequence[str] = ()) -> tuple[str, int]:
    """Write a load's rows to a folder of their own: its path and row count."""
    path = f"{raw_dir.rstrip('/')}/{name}/v={version}"
    if path in loaded:
        raise ValueError(f"load {version} is already part of {name}")
    seen = Observation(f"load_{name}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return path, seen.get.get("rows") or 0


def _gate(staged: dict[str, DataFrame], whole: dict[str, DataFrame]) -> None:
    """B3: the constraints of a load's own rows, before they become part of a table."""
    report = [Q.not_null(df, name, checks.NOT_NULL[name]) for name, df in staged.items()]
    report += [Q.referential(staged[child], child, key, whole[parent], parent_key)
               for child, key, parent, parent_key in checks.FOREIGN_KEYS if child in staged]
    Q.enforce(Q.union_all(report))


def load_bundles(spark: SparkSession, landing: str, raw_dir: str, version: str,
                 current: dict[str, list[str]] | None = None, layout: str = "file",
                 glob: str = "*.json") -> dict[str, list[str]]:
    """Append the new rows of landed bundles to the three clinical raw tables.

    Rows are written parents before children (patients, encounters,
    conditions) and checked against all parents; a row that breaks a constraint
    fails the whole load.  Bundles that cannot be read are stored, with file
    and reason, as ``rejected_bundles``.
    """
    current = {name: _listed(paths) for name, paths in (current or {}).items()}
    ing = B.Ingest(spark, landing, layout, glob, scratch=scratch_path(spark, "bundles-parsed"))
    out = {}
    path, n = _write_load(stamp(B.rejects(ing.rejected)), raw_dir, "rejected_bundles", version,
                          current.get("rejected_bundles", []))
    out["rejected_bundles"] = [*current.get("rejected_bundles", []), path]
    if n:
        log.warning("rejected %s bundles, see %s", n, path)
    staged, whole = {}, {}
    for name, schema in (("patients", schemas.PATIENTS), ("encounters", schemas.ENCOUNTERS),
                         ("conditions", schemas.CONDITIONS)):
        before = current.get(name, [])
        fresh = fresh_rows(getattr(ing, name), schemas.KEYS[name], list(B.LINEAGE),
                           read_table(spark, before) if before else None)
        path, n = _write_load(stamp(fresh.select(*schemas.columns(schema))), raw_dir, name, version, before)
        out[name] = [*before, path]
        staged[name], whole[name] = read_table(spark, path), read_table(spark, out[name])
        log.info("%s: %s new rows", name, n)
    _gate(staged, whole)
    return out


def load_weather(spark: SparkSession, observations: DataFrame, raw_dir: str, version: str,
                 current: str | Sequence[str] | None = None,
                 plan: DataFrame | None = None) -> list[str]:
    """Append cleaned observations of new keys to the weather table.

    The first row of a key in landing order wins, if the observations carry
    their file and row number as ``_file`` and ``_row``.  Observations without
    a whole key are stored as ``rejected_weather`` and fail the load.  With a
    request plan, planned locations without any observation are stored as
    ``weather_gaps`` and logged.
    """
    before = _listed(current)
    lineage = [c for c in ("_file", "_row") if c in observations.columns]
    keys = schemas.KEYS["weather"]
    batch, unkeyed = split_null_keys(clean_observations(observations, keep=tuple(lineage)), keys)
    path, n = _write_load(stamp(unkeyed), raw_dir, "rejected_weather", version)
    if n:
        raise Q.QualityError(f"{n} observations without a key, see {path}")
    stored = read_table(spark, before) if before else None
    fresh = fresh_rows(batch, keys, lineage, stored)
    last = stored.agg(F.max("id")).first()[0] if before else None
    fresh = number_rows(fresh, keys, "id", last or 0)
    path, n = _write_load(stamp(fresh.select(*schemas.columns(schemas.WEATHER))), raw_dir, "weather",
                          version, before)
    log.info("weather: %s new rows", n)
    out = [*before, path]
    if plan is not None:
        gaps, n = _write_load(coverage_gaps(plan, read_table(spark, out)), raw_dir, "weather_gaps", version)
        if n:
            log.warning("no observations for %s planned locations, see %s", n, gaps)
    return out


def load_icd(spark: SparkSession, documents: DataFrame, root_url: str, raw_dir: str, version: str,
             current: str | Sequence[str] | None = None, links: DataFrame | None = None) -> list[str]:
    """Walk landed entity documents from ``root_url`` and replace their codes.

    A code that the walk reaches takes its new values and load time, others
    stay as they are.  A code reached under two URLs fails the load, as a row
    cannot be replaced twice; a walk without codes leaves the table as it was.
    Children are read from the documents unless ``links`` gives them.
    """
    before = _listed(current)
    keys = schemas.KEYS["icd_codes"]
    links = links_from_documents(documents) if links is None else links
    batch = reliable_checkpoint(stamp(
        flatten(spark, parse_entities(documents), links, root_url)
        .select(*schemas.columns(schemas.ICD_CODES))))
    if batch.isEmpty():
        log.warning("no codes found below %s", root_url)
        return before
    _gate({"icd_codes": batch}, {})
    Q.enforce(Q.unique(batch, "icd_codes", keys))
    table = upsert_replace(read_table(spark, before), batch, keys, keys) if before else batch
    path, n = _write_load(table, raw_dir, "icd_codes", version, before)
    log.info("icd_codes: %s rows now", n)
    return [path]


def store_bundles(store: RawStore, landing: str, version: str, layout: str = "file",
                  glob: str = "*.json") -> State:
    """``load_bundles`` into a store: all tables of the load are published at once."""
    load = Load(store, f"bundles-{version}")
    try:
        good, rejected = B.quarantine(load.kept(B.typed(B.entries(B.scan(store.spark, landing, layout, glob))), "bundles"))
        n = load.add_log("rejected_bundles", B.rejects(rejected))
        if n:
            log.warning("rejected %s bundles", n)
        for name in ("patients", "encounters", "conditions"):
            load.add(name, B.typed_rows(good, name), list(B.LINEAGE), origin=B.LINEAGE, written=True)
        return load.commit()
    finally:
        load.close()


def store_weather(store: RawStore, observations: DataFrame, version: str, plan: DataFrame | None = None) -> State:
    """``load_weather`` into a store."""
    load = Load(store, f"weather-{version}")
    try:
        lineage = [c for c in ("_file", "_row") if c in observations.columns]
        load.add("weather", clean_observations(observations, keep=tuple(lineage)), lineage, origin=lineage)
        if plan is not None:
            n = load.add_log("weather_gaps", coverage_gaps(plan, load.table("weather")))
            if n:
                log.warning("no observations for %s planned locations", n)
        return load.commit()
    finally:
        load.close()


def store_icd(store: RawStore, documents: DataFrame, root_url: str, version: str,
              links: DataFrame | None = None) -> State:
    """``load_icd`` into a store: the code table's one folder is replaced."""
    load = Load(store, f"codes-{version}")
    links = links_from_documents(documents) if links is None else links
    batch = reliable_checkpoint(
        flatten(store.spark, parse_entities(documents), links, root_url).select(*schemas.columns(schemas.ICD_CODES)))
    if batch.isEmpty():
        log.warning("no codes found below %s", root_url)
        return load.read
    _gate({"icd_codes": batch}, {})
    keys = schemas.KEYS["icd_codes"]
    Q.enforce(Q.unique(batch, "icd_codes", keys))
    load.replace("icd_codes", upsert_replace(load.table("icd_codes"), stamp(batch), keys, keys))
    return load.commit()


def _raw(spark: SparkSession, paths: dict[str, str | list[str]] | RawStore) -> SimpleNamespace:
    """The raw tables of a store's state now, or of lists of load folders."""
    if isinstance(paths, RawStore):
        state = paths.state()
        return SimpleNamespace(**{n: paths.table(n, state).drop(LOADED_AT) for n in checks.RAW_TABLES})
    return SimpleNamespace(**{n: read_table(spark, paths[n]).drop(LOADED_AT) for n in checks.RAW_TABLES})


def check_raw(spark: SparkSession, paths: dict[str, str | list[str]] | RawStore) -> DataFrame:
    """Run the DQ suite over written raw tables and raise on any failure."""
    return Q.enforce(checks.dq_report(_raw(spark, paths)))


def register_views(spark: SparkSession, wh: Warehouse) -> None:
    """B5: staging and intermediate models as (always fresh) temp views."""
    for name in ("stg_patients", "stg_encounters", "stg_conditions", "stg_weather",
                 "stg_icd_codes", "int_patient_conditions", "int_encounters_weather"):
        getattr(wh, name).createOrReplaceTempView(name)


def build_marts(spark: SparkSession, paths: dict[str, str | list[str]] | RawStore, marts_dir: str,
                gate: bool = True) -> dict[str, str]:
    """B6: rebuild every mart from the current raw versions."""
    if gate:
        check_raw(spark, paths)
    wh = Warehouse(_raw(spark, paths))
    register_views(spark, wh)
    return wh.materialize(marts_dir)
