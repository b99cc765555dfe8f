from pyspark.sql import functions as F

import pytest

from pluvial.operators.upsert import duplicate_keys, first_wins, last_wins, split_null_keys, \
    upsert_ignore, upsert_replace


def test_first_and_last_wins(spark):
    batch = spark.createDataFrame(
        [("k1", 3, "c"), ("k1", 1, "a"), ("k1", 2, "b"), ("k2", 5, "x")], "k string, o int, v string")
    first = {r.k: r.v for r in first_wins(batch, ["k"], ["o"]).collect()}
    last = {r.k: r.v for r in last_wins(batch, ["k"], ["o"]).collect()}
    assert first == {"k1": "a", "k2": "x"} and last == {"k1": "c", "k2": "x"}


def test_ties_are_broken_by_payload(spark):
    batch = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a")], "k string, o int, v string")
    assert first_wins(batch, ["k"], ["o"]).collect()[0].v == "a"
    assert last_wins(batch, ["k"], ["o"]).collect()[0].v == "b"


def test_upsert_ignore_keeps_existing_and_is_idempotent(spark):
    target = spark.createDataFrame([("k1", "old")], "k string, v string")
    batch = spark.createDataFrame([("k1", "new", 1), ("k2", "b2", 2), ("k2", "b1", 1)],
                                  "k string, v string, o int")
    once = upsert_ignore(target, batch, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == [("k1", "old"), ("k2", "b1")]
    twice = upsert_ignore(once, batch, ["k"], ["o"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_replace(spark):
    target = spark.createDataFrame([("A", "t1"), ("B", "t2")], "code string, title string")
    batch = spark.createDataFrame([("A", "new1", 1), ("A", "new2", 2), ("C", "c", 1)],
                                  "code string, title string, o int")
    out = sorted(map(tuple, upsert_replace(target, batch, ["code"], ["o"]).collect()))
    assert out == [("A", "new2"), ("B", "t2"), ("C", "c")]
    assert [r.code for r in duplicate_keys(batch, ["code"]).collect()] == ["A"]


def test_hot_key_is_exact(spark):
    # one key holds a third of the rows; the winner must still be exact
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        ((F.col("id") * 7919) % n).alias("o"), F.col("id").alias("v"))
    out = first_wins(df.repartition(8), ["k"], ["o"])
    hot = out.where("k = 'hot'").collect()
    assert len(hot) == 1 and hot[0].o == 0
    assert out.count() == n - n // 3 + 1


def test_null_keys_are_refused_or_split_off(spark):
    target = spark.createDataFrame([("k1", "old")], "k string, v string")
    batch = spark.createDataFrame([(None, "2", 1), ("b", "3", 2)], "k string, v string, o int")
    for upsert in (upsert_ignore, upsert_replace):
        with pytest.raises(Exception, match="NULL key in column k"):
            upsert(target, batch, ["k"], ["o"]).collect()
    keyed, rejected = split_null_keys(batch, ["k"])
    assert [r.v for r in rejected.collect()] == ["2"]
    assert sorted(r.k for r in upsert_ignore(target, keyed, ["k"], ["o"]).collect()) == ["b", "k1"]
