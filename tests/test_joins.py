"""Joins with hot keys and lookups: the same rows, and plans that do not move what they need not."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pluvial.operators import joins as J
from pluvial.plans import analytics as K
from pluvial.plans import marts
from pluvial.plans.warehouse import Warehouse

import __spark_entry__ as E


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def visits(spark):
    return spark.range(300).select((F.col("id") % 150).alias("p"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("e"),
                                   (F.col("id") * 2).alias("x"))


@pytest.fixture(scope="module")
def conditions(spark):
    """A third of all rows belong to one visit, a few hundred to another; NULL keys too."""
    key = F.when(F.col("id") < 1000, 7).when(F.col("id") < 1400, 13).when(F.col("id") < 1500, None).otherwise(F.col("id") % 400)
    return spark.range(3000).select((key % 150).alias("p"), key.alias("e"), F.concat(F.lit("c"), "id").alias("c"))


def test_hot_keys_are_exact(conditions):
    assert sorted(J.hot_keys(conditions, ["p", "e"], share=0.1, rows=1)) == [(7, 7), (13, 13)]
    assert J.hot_keys(conditions, ["p", "e"], share=0.2, rows=1) == [(7, 7)]
    assert J.hot_keys(conditions, ["p", "e"]) == []                     # too few rows to care
    assert J.hot_keys(conditions.limit(0), ["p", "e"], rows=1) == []


@pytest.mark.parametrize("salts", [1, 5, 64])
def test_left_join_of_hot_keys_is_the_left_join(visits, conditions, salts):
    hot = J.hot_keys(conditions, ["p", "e"], share=0.1, rows=1)
    want = rows(visits.join(conditions, ["p", "e"], "left").select("p", "e", "x", "c"))
    assert rows(J.left_join_hot(visits, conditions, ["p", "e"], hot, salts)) == want
    assert rows(J.left_join_hot(visits, conditions, ["p", "e"], [])) == want
    # a hot key that no visit has
    assert rows(J.left_join_hot(visits.where("e <> 7 OR e IS NULL"), conditions, ["p", "e"], hot, salts)) == \
        [r for r in want if r[1] != 7]


@pytest.mark.parametrize("limit,share", [(1 << 20, 0.01), (0, 0.01), (0, 0.9)])
def test_lookup_join_is_the_left_join(visits, conditions, limit, share):
    small = visits.where("e IS NOT NULL").select("e", F.concat(F.lit("title "), "e").alias("title"))
    want = rows(conditions.join(small, "e", "left").select("p", "e", "c", "title"))
    assert rows(J.lookup_join(conditions, small, ["e"], limit, share, 1)) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conditions_do_not_move_to_their_codes(spark):
    wh = Warehouse.from_folder(spark, SF_SMALL)
    plan = plan_of(wh.dim_conditions)
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"Exchange hashpartitioning\(condition_code#\d+,", plan)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:        # a large code table: both sides move
        moved = plan_of(J.lookup_join(wh.stg_conditions, wh.stg_icd_codes.withColumnRenamed("code", "condition_code"),
                                      ["condition_code"], limit=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"Exchange hashpartitioning\(condition_code#\d+,", moved)


def test_fact_reads_each_raw_table_once(spark):
    plan = plan_of(E.queries()["fct_encounters"](spark, SF_SMALL))
    for table in ("customer", "orders", "nation", "region", "supplier", "lineitem"):
        assert len(re.findall(rf"/{table}\.parquet", plan)) == 1, table
    assert len(re.findall(r"FileScan parquet", plan)) == 7               # with the landed conditions


def test_fact_with_hot_visits(spark, monkeypatch):
    """Visits with the most diagnoses there are count as hot."""
    wh = Warehouse.from_folder(spark, SF_SMALL)
    hot = J.hot_keys(wh.stg_conditions, marts.VISIT_KEY, share=0.0005, rows=6)
    assert 0 < len(hot)
    got = marts.fct_encounters(wh.int_encounters_weather, wh.stg_conditions, hot)
    want = wh.fct_encounters
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_merged_sketches_stay_within_their_bound(spark):
    """Ten thousand patients a region over a year of days, any period a merge."""
    visits = spark.range(60_000).select(
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("patient_id"),
        F.expr("cast(date_add(date'2020-01-01', cast(id % 365 as int)) as timestamp)").alias("period_start"))
    patients = spark.range(20_000).select(F.concat(F.lit("p"), "id").alias("patient_id"),
                                          F.lit("s").alias("state"), (F.col("id") % 2).cast("string").alias("city"))
    daily = K.visit_sketches(visits, patients)
    assert daily.count() == 730
    for first, last in (("2020-01-01", "2020-12-30"), ("2020-02-01", "2020-02-29"), ("2020-05-05", "2020-05-05")):
        bounds = [F.lit(d).cast("date") for d in (first, last)]
        got = K.period_patients(daily, visits, patients, *bounds).collect()
        assert len(got) == 2 and all(r.close and r.patients > 50 for r in got)
