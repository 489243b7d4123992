"""Registered queries against DuckDB at the smallest scale; all of them with TIDEMARK_ALL_QUERIES=1."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.session import SETTINGS

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ("sma", "macd", "adx", "clean_stock", "dominance_asof", "corr_by_period", "calendar_seasonality", "financial_ratios", "upsert_prices", "explode_chart",
        "load_after_failure", "stock_directory_summary", "company_directory", "decompose_auto", "turning_points_by_length", "corr_clusters", "corr_kendall")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("TIDEMARK_ALL_QUERIES") else SOME)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert got == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "trend_label" in df.columns


def test_settings_reach_a_foreign_session(spark):
    entry.entry(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == SETTINGS["spark.sql.session.timeZone"]
