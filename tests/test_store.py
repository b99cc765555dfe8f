"""The raw store: manifests, gated loads, compaction, stale writers."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pluvial.operators.quality import QualityError
from pluvial.operators.ranks import number_rows
from pluvial.plans import jobs
from pluvial.plans.store import Load, RawStore, StaleWriter, State
from pluvial.sources import bundles as B
from pluvial.sources import derived as D
from pluvial.sources.tables import Tables

PATIENT = ("id string, birthdate date, gender string, city string, state string, lat double, lon double, "
           "deceased_datetime timestamp, _row int")


def patients(spark, *rows):
    return spark.createDataFrame([(i, None, None, city, None, None, None, None, n) for n, (i, city) in enumerate(rows)], PATIENT)


def loaded(store, version, *rows, strict=True):
    load = Load(store, version, strict=strict)
    load.add("patients", patients(store.spark, *rows), ["_row"], origin=["_row"])
    return load.commit()


def cities(store, state=None):
    return {r.id: r.city for r in store.table("patients", state).collect()}


def test_load_compact_load(spark, tmp_dir):
    store = RawStore(spark, os.path.join(tmp_dir, "a"), buckets=4)
    assert store.state() == State(buckets=4) and cities(store) == {}
    first = loaded(store, "1", ("p1", "first"), ("p1", "second"), ("p2", "x"))
    second = loaded(store, "2", ("p2", "later"), ("p3", "y"))
    stamps = {r.id: r.loaded_at for r in store.table("patients").collect()}
    compact = store.compact("patients")
    assert len(second.tables["patients"]) == 2 and len(compact.tables["patients"]) == 1
    # a reader that holds the older list still reads the same rows
    assert cities(store, second) == cities(store) == {"p1": "first", "p2": "x", "p3": "y"}
    assert cities(store, first) == {"p1": "first", "p2": "x"}
    third = loaded(store, "3", ("p1", "again"), ("p4", "z"))
    assert cities(store) == {"p1": "first", "p2": "x", "p3": "y", "p4": "z"}
    assert {i: t for i, t in ((r.id, r.loaded_at) for r in store.table("patients").collect()) if i in stamps} == stamps
    # the same rows in one load
    other = RawStore(spark, os.path.join(tmp_dir, "b"), buckets=7)
    loaded(other, "1", ("p1", "first"), ("p1", "second"), ("p2", "x"), ("p3", "y"), ("p4", "z"))
    assert cities(other) == cities(store)
    gone = store.vacuum(keep=2)
    assert gone == ["patients/v=1", "patients/v=2"] and store.versions() == [third.version - 1, third.version]
    assert cities(store) == cities(store, compact) | {"p4": "z"}
    # a store keeps the buckets it was made with
    assert RawStore(spark, os.path.join(tmp_dir, "a"), buckets=99).buckets == 4


def test_a_stale_writer_is_refused(spark, tmp_dir):
    store = RawStore(spark, tmp_dir, buckets=2)
    one, two = Load(store, "1"), Load(store, "2")
    for load in (one, two):
        load.add("patients", patients(spark, ("p1", load.version)), ["_row"])
    one.commit()
    with pytest.raises(StaleWriter, match="patients"):
        two.commit()
    assert cities(store) == {"p1": "1"}
    with pytest.raises(ValueError, match="already part"):
        Load(store, "1").add("patients", patients(spark, ("p2", "x")), ["_row"])
    # a compaction that lost a race is refused too; another table's change is built upon
    read = store.state()
    loaded(store, "3", ("p3", "x"))
    with pytest.raises(StaleWriter):
        store.publish(read, {"patients": ["patients/v=9"]})
    new = store.publish(read, {"icd_codes": ["icd_codes/v=1"]}, {"stream": 0})
    assert new.tables["patients"] == store.state().tables["patients"] and new.epochs == {"stream": 0}
    with pytest.raises(StaleWriter, match="stream"):
        store.publish(read, {}, {"stream": 0})


def test_strict_loads_fail_before_they_are_published(spark, tmp_dir):
    store = RawStore(spark, tmp_dir, buckets=2)
    with pytest.raises(QualityError, match="1 rows break constraints"):
        loaded(store, "1", ("p1", "x"), (None, "y"))
    assert store.versions() == [] and cities(store) == {}
    loaded(store, "1", ("p1", "x"), (None, "y"), strict=False)       # the retry starts anew
    assert cities(store) == {"p1": "x"} and store.table("rejected_rows").count() == 1


def test_a_good_row_is_not_lost_behind_a_bad_one_of_its_key(spark, tmp_dir):
    store = RawStore(spark, tmp_dir, buckets=2)
    load = Load(store, "1", strict=False)
    load.add("patients", patients(spark, ("p1", "x")), ["_row"])
    visits = spark.createDataFrame([("e1", "nobody", 0), ("e1", "p1", 1), ("e1", None, 2)],
                                   "encounter_id string, patient_id string, _row int")
    for c in ("status", "class_code", "type_code", "type_display", "practitioner_display", "location_display",
              "service_provider_display", "reason_code", "reason_display"):
        visits = visits.withColumn(c, F.lit(None).cast("string"))
    visits = visits.withColumns({c: F.lit(None).cast("timestamp") for c in ("period_start", "period_end")})
    load.add("encounters", visits, ["_row"])
    load.commit()
    assert [(r.encounter_id, r.patient_id) for r in store.table("encounters").collect()] == [("e1", "p1")]
    assert sorted(r.reason for r in store.table("rejected_rows").collect()) == [
        "NULL in patient_id", "no patients for patient_id"]


def test_jobs_on_a_store(spark, tmp_dir):
    """All raw tables through the store, marts from it, and the same again as a no-op."""
    raw, t = D.RawLayer(spark, SF_SMALL), Tables(spark, SF_SMALL)
    store = RawStore(spark, os.path.join(tmp_dir, "store"), buckets=4)
    landing = B.write_bundles(raw.patients, raw.encounters, raw.conditions, os.path.join(tmp_dir, "landing"))
    from pluvial.sources import weather as W
    plan = W.request_plan(raw.patients, raw.encounters)
    for version in ("1", "2"):
        jobs.store_bundles(store, landing, version, layout="lines", glob="*.txt")
        jobs.store_weather(store, D.weather_observations(t).where("lat <> 40.3"), version, plan=plan)
        jobs.store_icd(store, D.hierarchy_documents(t), D.HIERARCHY_ROOT, version, links=D.hierarchy_links(t))
        for name in ("patients", "encounters", "conditions"):
            want = getattr(raw, name)
            got = store.table(name).select(*want.columns)
            assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    gaps = {(r.lat, r.lon) for r in store.table("weather_gaps").collect()}
    have = {(r.lat, r.lon) for r in store.table("weather").select("lat", "lon").distinct().collect()}
    assert gaps == {(r.lat, r.lon) for r in plan.collect()} - have and (40.3, -70.3) in gaps and have
    assert len(store.state().tables["icd_codes"]) == 1
    paths = jobs.build_marts(spark, store, os.path.join(tmp_dir, "marts"))
    assert spark.read.parquet(paths["dim_weather"]).count() == store.table("weather").count() > 0
    assert spark.read.parquet(paths["fct_encounters"]).count() >= raw.encounters.count()


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_numbers_are_dense_and_in_order(spark, parts):
    df = spark.range(1000).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = sorted(number_rows(df, ["k"], "n", after=41, partitions=parts).collect())
    assert [r.n for r in got] == list(range(42, 1042))
    assert number_rows(df.limit(0), ["k"], "n").count() == 0


def test_rows_do_not_move_to_their_parents(spark, tmp_dir):
    store = RawStore(spark, tmp_dir, buckets=4)
    load = Load(store, "1", strict=False)
    load.add("patients", spark.sql("""SELECT concat('p', id) AS id, DATE'1990-01-01' AS birthdate, 'male' AS gender, 'c' AS city,
        's' AS state, 1D AS lat, 2D AS lon, CAST(NULL AS TIMESTAMP) AS deceased_datetime FROM range(50)"""), ["id"])
    rows = spark.sql("SELECT id, IF(id = 7, NULL, concat('p', id % 60)) AS patient_id, CAST(NULL AS STRING) AS _reason FROM range(600)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # the parents are too many to broadcast
    try:
        judged = load._judged(rows, ["patient_id"], "patients")
        assert "hashpartitioning" not in judged._jdf.queryExecution().executedPlan().toString()
        bad = {r.id for r in judged.where("_reason = 'no patients for patient_id'").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        load.close()
    assert bad == {k for k in range(600) if k % 60 >= 50}


def test_writes_of_a_load_leave_no_shuffle_files(spark, tmp_dir):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return sum(os.path.getsize(f"{at}/{f}") for d in folders for at, _, files in os.walk(d) for f in files
                   if f.startswith("shuffle_") and f.endswith(".data"))

    store = RawStore(spark, os.path.join(tmp_dir, "store"), buckets=4)
    load = Load(store, "1")
    before = shuffled()
    kept = load.kept(spark.range(50_000).selectExpr("hash(id) id").distinct(), "ids")
    place, n = store.write(spark.range(20_000).selectExpr(
        "concat('p', id) id", "cast(null as date) birthdate", "'male' gender", "'c' city", "'s' state", "1D lat", "2D lon",
        "cast(null as timestamp) deceased_datetime", "current_timestamp() loaded_at"), "patients", "1")
    assert shuffled() - before < 10_000      # of its counts; the rows of either are over 100,000 bytes
    assert (kept.distinct().count(), n, store.scan("patients", [place]).count()) == (kept.count(), 20_000, 20_000)
    assert shuffled() - before > 100_000     # what is not a write keeps its files for now
    load.close()
