"""Answers that must not depend on block sizes, the order of names, or the order of records."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException

from tidemark.operators import correlation as co
from tidemark.operators import factors as fa
from tidemark.operators import stationarity as st
from tidemark.operators import trend as tr
from tidemark.operators import upsert as up
from tidemark.sources import files, html, payloads


def test_regimes_need_all_assets_of_the_whole_input(spark, monkeypatch):
    rng = np.random.default_rng(4)
    days = pd.date_range("2020-01-01", periods=400).date
    rows = [(days[k], asset, float(v)) for asset, start in (("A", 0), ("B", 0), ("C", 250)) for k, v in enumerate(rng.normal(size=400)) if k >= start]
    df = spark.createDataFrame(rows, "date date, asset string, value double").cache()
    seen = []
    for block in (64, 4096):
        monkeypatch.setattr(co, "DATES_PER_BLOCK", block)
        seen.append({r.date: round(r.difference, 9) for r in co.adjacent_difference(df, 20).collect() if r.difference is not None})
    assert seen[0] == seen[1] and min(seen[0]) >= days[250]


def test_rectangular_and_upper_matrices_keep_every_pair(spark, tmp_path):
    doc = '{"calc_date": "2024-01-02", "stocks_vs_crypto": {"matrix": {"Z": {"A": 0.1, "B": 0.2}, "B2": {"A": 0.3, "B": 0.4}}}}'
    got = {(r.symbol_1, r.symbol_2): r["corr"] for r in payloads.correlation_documents(spark.createDataFrame([(doc,)], "payload string")).collect()}
    assert got == {("A", "Z"): 0.1, ("B", "Z"): 0.2, ("A", "B2"): 0.3, ("B", "B2"): 0.4}
    (tmp_path / "m.csv").write_text(",Z,A,M\nZ,1,0.5,0.6\nA,,1,0.7\nM,,,1\n")
    got = {(r.symbol_1, r.symbol_2): r["corr"] for r in files.matrix_csv(spark, str(tmp_path / "m.csv")).collect()}
    assert got == {("A", "Z"): 0.5, ("M", "Z"): 0.6, ("A", "M"): 0.7}


def test_contradicting_records_need_a_sequence(spark):
    rows = spark.createDataFrame([(1, 10.0, 1.0, 1), (1, 7.0, 3.0, 2)], "k int, hi double, lo double, seq int")
    last = up.latest(rows, ["k"], "seq").first()
    assert (last.hi, last.lo) == (7.0, 3.0)
    with pytest.raises(PySparkException):
        up.latest(rows.drop("seq"), ["k"]).collect()
    same = rows.drop("seq").where("hi = 7")
    assert up.latest(same.union(same), ["k"]).count() == 1


def test_short_series_have_no_trend_changes(spark):
    x = np.concatenate([np.arange(23.0), np.arange(23.0)[::-1]]) + 100
    days = pd.date_range("2020-01-01", periods=46).date
    df = spark.createDataFrame([("S", d, float(v)) for d, v in zip(days, x)], "symbol string, date date, close double")
    assert tr.trend_changes(df, 20).count() == 0 and tr.trend_changes(df, 10).count() > 0


def test_clusters_leave_out_assets_without_correlation(spark):
    m = spark.createDataFrame([("a", "b", 0.9), ("a", "k", None), ("b", "k", None), ("a", "c", 0.1), ("b", "c", 0.1), ("c", "k", None)], "symbol_1 string, symbol_2 string, corr double")
    assert {r.symbol: r.cluster for r in fa.average_linkage(m, 2).collect()} == {"a": 0, "b": 0, "c": 1}


def test_filings_of_several_pages_and_any_quotes(spark):
    row = "<tr><td>10-K</td><td><a id='x'>d</a></td><td>t</td><td>2024-01-0{}</td></tr>"
    page = "<table class='wide tableFile2'><tr><th>h</th></tr>" + "".join(row.format(k) for k in (1, 2, 3)) + "</table>"
    got = html.filing_rows(spark.createDataFrame([("c", page), ("c", page.replace("'wide tableFile2'", "tableFile2"))], "company string, html string"), limit=2).collect()
    assert sorted((r["rank"], r.filing_date) for r in got) == [(1, "2024-01-01")] * 2 + [(2, "2024-01-02")] * 2


def test_stationarity_of_series_of_any_length(spark):
    x = np.cumsum(np.random.default_rng(2).normal(size=900))
    days = pd.date_range("2000-01-01", periods=900).date
    rows = [("L", d, float(v)) for d, v in zip(days, x)] + [("ONE", dt.date(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    lags = {r.symbol: r.lags for r in st.kpss(df).collect()}
    assert lags["L"] > 4
    assert {r.symbol for r in st.adf(df.where("symbol = 'L'")).collect()} == {"L"}


def test_global_lists_of_unequal_length_give_nothing(spark):
    docs = spark.createDataFrame([('{"date": ["2024-01-01", "2024-01-02"], "total_market_cap": {"usd": [1.0]}}',)], "payload string")
    assert payloads.global_market(docs).count() == 0
