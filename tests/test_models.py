from pyspark.sql import functions as F

from conftest import SF_SMALL
from pluvial.plans.warehouse import Warehouse


def test_fact_invariants(spark):
    wh = Warehouse.from_folder(spark, SF_SMALL)
    visits = wh.int_encounters_weather
    fact = wh.fct_encounters
    n_enc_with_patient = wh.stg_encounters.join(wh.stg_patients, "patient_id", "left_semi").count()
    assert visits.count() == n_enc_with_patient
    assert fact.count() >= visits.count()
    # grain: (encounter, condition) is unique
    assert fact.groupBy("encounter_id", "condition_id").count().where("count > 1").count() == 0
    # is_chronic comes from staging: NULL, not TRUE, where there is no condition
    no_cond = fact.where(F.col("condition_id").isNull())
    assert no_cond.count() > 0
    assert no_cond.where(F.col("is_chronic").isNotNull()).count() == 0


def test_weather_surrogate_key_is_dense_and_stable(spark):
    from pluvial.sources import derived as D
    from pluvial.sources.tables import Tables
    a, b = (sorted(map(tuple, D.numbered_weather(Tables(spark, SF_SMALL)).collect())) for _ in range(2))
    assert a == b and [r[0] for r in a] == list(range(1, len(a) + 1))
    assert [r[1:4] for r in a] == sorted(r[1:4] for r in a)


def test_dim_dates_covers_visits(spark):
    wh = Warehouse.from_folder(spark, SF_SMALL)
    d = wh.dim_dates
    assert d.select("date").distinct().count() == d.count()
    missing = wh.fct_encounters.select("encounter_date").distinct() \
        .join(d.withColumnRenamed("date", "encounter_date"), "encounter_date", "left_anti")
    assert missing.count() == 0


def test_materialize_writes_marts(spark, tmp_dir):
    wh = Warehouse.from_folder(spark, SF_SMALL)
    paths = wh.materialize(tmp_dir)
    fact = spark.read.parquet(paths["fct_encounters"])
    assert fact.count() == wh.fct_encounters.count()
    assert "encounter_month" in fact.columns


def test_top_k_returns_k_per_region(spark):
    from pluvial.plans import analytics as K
    wh = Warehouse.from_folder(spark, SF_SMALL)
    top = K.top_diagnoses_by_region(wh.stg_patients, wh.stg_conditions, k=2)
    per_region = top.groupBy("state", "city").count().collect()
    assert per_region and all(r["count"] <= 2 for r in per_region)


def test_chi_square_matches_ml_test(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest

    from pluvial.operators import stats
    a, b, c, d = 30, 70, 45, 55
    cells = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long")
    mine = stats.two_by_two(cells, "a", "b", "c", "d").collect()[0]
    rows = ([(1.0, Vectors.dense([1.0]))] * a + [(0.0, Vectors.dense([1.0]))] * b
            + [(1.0, Vectors.dense([0.0]))] * c + [(0.0, Vectors.dense([0.0]))] * d)
    ref = ChiSquareTest.test(spark.createDataFrame(rows, ["label", "features"]),
                             "features", "label").collect()[0]
    assert abs(mine.chi2 - ref.statistics[0]) < 1e-6
    assert abs(mine.p_value - ref.pValues[0]) < 1e-6


def test_chi_square_tail_is_right_in_its_leading_digits(spark):
    import math

    from pluvial.operators import stats
    xs = [0.0, 1e-9, 0.3, 1.0, 1.9999, 2.0, 3.0, 5.0, 8.0, 20.0, 26.0]
    x = F.col("x")
    rows = spark.createDataFrame([(v,) for v in xs], "x double").select(
        "x", stats.erfc_nonneg(x).alias("p"), stats.log10_erfc_nonneg(x).alias("log_p")).collect()
    for r in rows:
        assert math.isclose(r.p, math.erfc(r.x), rel_tol=1e-11)
        assert math.isclose(r.log_p, math.log10(math.erfc(r.x)), rel_tol=1e-11, abs_tol=1e-11)
    far = spark.range(1).select(stats.log10_erfc_nonneg(F.lit(700.0))).first()[0]
    # the first terms of the asymptotic series
    assert math.isclose(far, -700**2 / math.log(10) - math.log10(700 * math.sqrt(math.pi)) - 0.5 / 700**2 / math.log(10),
                        rel_tol=1e-13)


def test_average_ranks_handle_ties_and_groups(spark):
    from pluvial.operators.ranks import average_ranks
    vals = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 5.0), ("b", 3.0), ("b", 3.0), ("a", None)]
    df = spark.createDataFrame(vals, "g string, x double")
    got = {(r.g, r.x): r.rank for r in average_ranks(df, "x", ["g"], partitions=3).collect()}
    assert got == {("a", 1.0): 1.0, ("a", 2.0): 2.5, ("a", 5.0): 4.0, ("b", 3.0): 1.5}
