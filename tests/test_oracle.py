"""Every registered query against its DuckDB oracle SQL on the smallest folder."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pluvial.catalog import QUERIES
from pluvial.oracle import oracle_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, int):
        return (2, str(v))
    if isinstance(v, (float, decimal.Decimal)):
        return (3, repr(round(float(v), 9) + 0.0))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (5, v.isoformat())
    return (6, str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = _canon(df.columns, df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    d_cols, d_rows = _canon(list(rel.columns), rel.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["state", "city", "rainy_pain_patients"]
    assert df.count() > 0
