import datetime as dt

import duckdb
from pyspark.sql import functions as F

from pluvial.functions import exprs as X
from pluvial.plans.marts import date_spine


def test_age_years_matches_calendar_age(spark):
    days = [dt.date(2000, 2, 29), dt.date(2001, 2, 28), dt.date(2001, 3, 1), dt.date(2004, 2, 29),
            dt.date(1999, 12, 31), dt.date(2000, 1, 31), dt.date(2000, 3, 31), dt.date(2000, 4, 30),
            dt.date(2023, 3, 31), dt.date(2024, 2, 29), dt.date(1970, 1, 1), dt.date(2024, 12, 31)]
    pairs = [(a, b) for a in days for b in days]
    df = spark.createDataFrame(pairs, "on date, born date")
    got = {(r.on, r.born): r.age for r in
           df.select("on", "born", X.age_years("on", "born").alias("age")).collect()}
    con = duckdb.connect()
    for on, born in pairs:
        want = con.execute("select cast(date_part('year', age(?::date, ?::date)) as int)",
                           [on, born]).fetchall()[0][0]
        assert got[(on, born)] == want, (on, born)


def test_weekend_and_padded_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),),
                                (dt.date(2024, 1, 8),)], "d date")
    rows = df.select(X.is_weekend("d").alias("w"), X.padded_day_name("d").alias("n"),
                     X.padded_month_name("d").alias("m")).collect()
    assert [r.w for r in rows] == [True, True, False]
    assert rows[0].n == "Saturday " and rows[2].n == "Monday   "
    assert rows[0].m == "January  " and all(len(r.n) == 9 for r in rows)


def test_season_and_categories(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    seasons = [r.s for r in df.select(X.season("m").alias("s")).collect()]
    assert seasons == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer",
                       "Summer", "Autumn", "Autumn", "Autumn", "Winter"]
    vals = [None, 0.0, -0.0, 0.1, 2.5, 7.59, 7.6, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    cats = [r.c for r in df.select(X.rain_category("p").alias("c")).collect()]
    assert cats == ["Unknown", "Dry", "Dry", "Light rain", "Moderate rain", "Moderate rain",
                    "Heavy rain", "Light rain"]
    temps = spark.createDataFrame([(v,) for v in [None, -0.5, 0.0, 9.99, 10.0, 19.9, 20.0]],
                                  "t double")
    assert [r.c for r in temps.select(X.temp_category("t").alias("c")).collect()] == \
        ["Unknown", "Freezing", "Cold", "Cold", "Mild", "Mild", "Warm"]


def test_duration_minutes_rounds_half_away_from_zero(spark):
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [(base, base + dt.timedelta(seconds=90)), (base, base - dt.timedelta(seconds=30)),
            (base, base + dt.timedelta(seconds=150)), (base, None), (None, base)]
    df = spark.createDataFrame(rows, "s timestamp, e timestamp")
    got = [r.d for r in df.select(X.duration_minutes("s", "e").alias("d")).collect()]
    assert got == [2, -1, 3, None, None]


def test_strip_urn_and_url_codes(spark):
    df = spark.createDataFrame([("urn:uuid:abc",), ("",), (None,), ("x",),
                                ("urn:uuid:a-urn:uuid:b",)], "r string")
    assert [r.v for r in df.select(X.strip_urn("r").alias("v")).collect()] == \
        ["abc", None, None, "x", "a-b"]
    urls = spark.createDataFrame([("http://h/icd/release/10/2019",), ("http://h/x/A00-A09/",),
                                  ("http://h/x/A00",)], "u string")
    assert [r.c for r in urls.select(X.code_from_url("u").alias("c")).collect()] == \
        [None, "A00-A09", "A00"]


def test_first_of_is_ansi_safe(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert [r.v for r in df.select(X.first_of("a").alias("v")).collect()] == [1, None, None]


def test_coordinate_rounding_half_up(spark):
    df = spark.createDataFrame([(40.00005,), (40.00004,), (-70.00005,), (None,)], "x double")
    got = [r.v for r in df.select(X.coord_key("x").alias("v")).collect()]
    assert got == [40.0001, 40.0, -70.0001, None]


def test_date_spine_bounds(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), dt.date(2024, 2, 2)),
                                (dt.date(2024, 3, 2), dt.date(2024, 3, 1)),
                                (None, dt.date(2024, 3, 1))], "a date, b date")
    days = [r.d for r in df.select(date_spine(F.col("a"), F.col("b")).alias("d")).collect()]
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1),
                    dt.date(2024, 2, 2)]


def test_pain_filter(spark):
    df = spark.createDataFrame([("Chronic pain (finding)",), ("chronic low back pain",),
                                ("Joint pain (finding)",), ("Arthralgia of knee",),
                                ("Hypertension",), (None,)], "d string")
    got = [r.p for r in df.select(X.is_pain_diagnosis("d").alias("p")).collect()]
    assert got == [True, True, True, True, False, None]


def test_absurd_coordinates_do_not_fail_a_load(spark):
    df = spark.createDataFrame([(1e6,), (12.34565,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(X.coord_key("x")).collect()] == [None, 12.3457, None, None]
