import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pluvial.operators.quality import QualityError
from pluvial.plans import analytics as K
from pluvial.plans import jobs
from pluvial.plans.warehouse import Warehouse
from pluvial.sources import bundles as B
from pluvial.sources import derived as D
from pluvial.sources.tables import Tables


def test_land_check_build(spark, tmp_dir):
    raw = D.RawLayer(spark, SF_SMALL)
    landing = B.write_bundles(raw.patients, raw.encounters, raw.conditions,
                              os.path.join(tmp_dir, "landing"))
    raw_dir = os.path.join(tmp_dir, "raw")
    v1 = jobs.load_bundles(spark, landing, raw_dir, "1", layout="lines", glob="*.txt")
    # re-running the same landing is a no-op (ON CONFLICT DO NOTHING)
    v2 = jobs.load_bundles(spark, landing, raw_dir, "2", current=v1, layout="lines", glob="*.txt")
    for name in ("patients", "encounters", "conditions"):
        a, b = jobs.read_table(spark, v1[name]), jobs.read_table(spark, v2[name])
        assert a.count() == b.count() == getattr(raw, name).count()
        assert "loaded_at" in a.columns
        # the second load appended a folder of its own, without a row
        assert v2[name][:-1] == v1[name] and spark.read.parquet(v2[name][-1]).isEmpty()
    t = Tables(spark, SF_SMALL)
    v2["weather"] = jobs.load_weather(spark, D.weather_observations(t), raw_dir, "1")
    v2["icd_codes"] = jobs.load_icd(spark, D.hierarchy_documents(t), D.HIERARCHY_ROOT, raw_dir, "1",
                                    links=D.hierarchy_links(t))
    want = D.icd_from_hierarchy(t).select("code", "title", "parent_code")
    codes = jobs.read_table(spark, v2["icd_codes"]).select("code", "title", "parent_code")
    assert codes.count() == want.count() > 0 and codes.exceptAll(want).isEmpty()
    marts = jobs.build_marts(spark, v2, os.path.join(tmp_dir, "marts"))
    fact = spark.read.parquet(marts["fct_encounters"]).drop("encounter_month")
    expected = Warehouse.from_folder(spark, SF_SMALL).fct_encounters
    assert fact.count() == expected.count()
    assert fact.exceptAll(expected.select(*fact.columns)).count() == 0
    assert spark.table("stg_conditions").count() == raw.conditions.count()


def test_orphans_fail_the_load_before_they_are_part_of_a_table(spark, tmp_dir):
    raw = D.RawLayer(spark, SF_SMALL)
    landing = B.write_bundles(raw.patients.where("id <> 'p2'"), raw.encounters, raw.conditions,
                              os.path.join(tmp_dir, "landing"))
    with pytest.raises(QualityError, match="referential"):
        jobs.load_bundles(spark, landing, os.path.join(tmp_dir, "raw"), "1", layout="lines", glob="*.txt")


def test_weather_keeps_the_first_landed_row_and_reports_gaps(spark, tmp_dir):
    rows = [(1.0, 2.0, dt.date(2020, 1, 1), t, None, None, None, None, "f", i)
            for i, t in enumerate((9.0, 1.0))]
    obs = spark.createDataFrame(rows, "lat double, lon double, date date, tavg double, tmin double, "
                                "tmax double, prcp double, pres double, _file string, _row int")
    plan = spark.createDataFrame([(1.0, 2.0), (5.0, 6.0)], "lat double, lon double")
    first = jobs.load_weather(spark, obs, tmp_dir, "1", plan=plan)
    second = jobs.load_weather(spark, obs, tmp_dir, "2", current=first)
    assert [r.tavg for r in jobs.read_table(spark, second).collect()] == [9.0]
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/weather_gaps/v=1").collect()] == [(5.0, 6.0)]
    with pytest.raises(ValueError):
        jobs.load_weather(spark, obs, tmp_dir, "2", current=second)
    with pytest.raises(QualityError):
        jobs.load_weather(spark, obs.withColumn("lat", F.lit(None).cast("double")), tmp_dir, "3", current=second)


def _code_documents(spark, titles):
    docs = [("u/root", {"title": {"@value": "root"}, "child": [f"u/{c}" for c in titles]})]
    docs += [(f"u/{c}", {"code": c, "title": {"@value": t}}) for c, t in titles.items()]
    return spark.createDataFrame([(u, json.dumps(d)) for u, d in docs], "url string, doc string")


def test_code_load_replaces_and_restamps_only_what_it_reached(spark, tmp_dir):
    v1 = jobs.load_icd(spark, _code_documents(spark, {"A00": "old", "A01": "stays"}), "u/root", tmp_dir, "1")
    v2 = jobs.load_icd(spark, _code_documents(spark, {"A00": "new", "A02": "added"}), "u/root", tmp_dir, "2", v1)
    a, b = ({r.code: r for r in jobs.read_table(spark, v).collect()} for v in (v1, v2))
    assert {c: r.title for c, r in b.items()} == {"A00": "new", "A01": "stays", "A02": "added"}
    assert b["A01"].loaded_at == a["A01"].loaded_at and b["A00"].loaded_at > a["A00"].loaded_at
    # nothing found: the table stays
    assert jobs.load_icd(spark, _code_documents(spark, {}), "u/root", tmp_dir, "3", v2) == v2
    twice = _code_documents(spark, {"A05": "x"}).union(spark.createDataFrame(
        [("u/root", json.dumps({"child": ["u/b"]})), ("u/b", json.dumps({"code": "A05"}))], "url string, doc string"))
    with pytest.raises(QualityError, match="unique"):
        jobs.load_icd(spark, twice, "u/root", tmp_dir, "4", v2)


def test_period_kpi_prunes_the_written_fact(spark, tmp_dir):
    wh = Warehouse.from_folder(spark, SF_SMALL)
    written = Warehouse.from_marts(spark, wh.raw, wh.materialize(tmp_dir))
    bounds = [F.lit(d).cast("date") for d in ("1995-01-01", "1995-06-30")]
    got = K.rainy_pain_patients_by_region(written.fct_encounters, wh.stg_patients, *bounds)
    plan = got._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*encounter_month", plan)
    want = K.rainy_pain_patients_by_region(wh.fct_encounters, wh.stg_patients, *bounds)
    assert sorted(got.collect()) == sorted(want.collect())
