"""Cleaning and scaling on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning as cl
from tidemark.operators.asof import nearest_by_date
from tidemark.operators.series import lay_out


def frame(spark, rows, schema="symbol string, day int, x double"):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day"))).drop("day")


def values(df, column="x", symbol=None):
    rows = df.orderBy("symbol", "date").select("symbol", column).collect()
    return [r[1] for r in rows if symbol in (None, r[0])]


GAPS = [("a", 0, None), ("a", 1, 1.0), ("a", 5, None), ("a", 6, None), ("a", 7, 4.0), ("a", 9, None), ("b", 0, 5.0), ("b", 3, None), ("c", 0, None)]


@pytest.mark.parametrize("block", [1, 2, None])
def test_interpolate(spark, block):
    out = cl.interpolate(lay_out(frame(spark, GAPS), block_rows=block), ["x"]).rows()
    assert values(out) == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0, 5.0, 5.0, None]


@pytest.mark.parametrize("block", [1, 2, None])
def test_fill_forward(spark, block):
    out = cl.fill_forward(lay_out(frame(spark, GAPS), block_rows=block), ["x"]).rows()
    assert values(out) == [1.0, 1.0, 1.0, 1.0, 4.0, 4.0, 5.0, 5.0, None]


def test_dedupe_keeps_first(spark):
    df = frame(spark, [("a", 0, 1.0), ("a", 0, 3.0), ("a", 0, 2.0), ("b", 0, 9.0)])
    assert values(cl.dedupe_first(df, ["x"])) == [1.0, 9.0]


def test_flat_series_scale_to_zero(spark):
    df = frame(spark, [("a", i, 3.0) for i in range(20)])
    assert set(values(cl.scale_minmax(df, ["x"]))) == {0.0}
    assert set(values(cl.scale_standard(df, ["x"]))) == {0.0}


def test_log_shift(spark):
    df = frame(spark, [("a", 0, -2.0), ("a", 1, 0.0), ("b", 0, 1.0)])
    got = values(cl.scale_log(df, ["x"]).withColumn("x", F.exp("x")))
    assert got == pytest.approx([1.0, 3.0, 1.0])
    coin = values(cl.scale_log(df, ["x"], 1e-6).withColumn("x", F.exp("x")))
    assert coin == pytest.approx([1e-6, 2 + 1e-6, 1.0])


def test_percent_change_drops_first(spark):
    out = cl.normalize(frame(spark, [("a", 0, 2.0), ("a", 1, 3.0), ("b", 0, 1.0)]), "percent")
    assert values(out, "x_pct_change") == [50.0]


def test_outliers_need_more_than_thirty_rows(spark):
    rows = [("few", i, 1.0 + i % 2) for i in range(29)] + [("few", 29, 1000.0)]
    rows += [("many", i, 1.0 + i % 2) for i in range(60)] + [("many", 60, 1000.0)]
    s = lay_out(frame(spark, rows))
    out = cl.winsorize(s, ["x"], cl.STOCK_OUTLIERS).rows()
    assert max(values(out, symbol="few")) == 1000.0
    assert max(values(out, symbol="many")) == 2.0


def test_clean_stock_data_sanity(spark):
    rows = [("a", i, 10.0, 8.0, 12.0, None if i == 3 else 11.0, -5.0) for i in range(6)]
    df = frame(spark, rows, "symbol string, day int, open double, high double, low double, close double, volume double")
    out = cl.clean_stock_data(df.unionByName(df), tie=["open"])
    got = out.select("high", "low", "close", "volume").distinct().collect()
    assert [tuple(r) for r in got] == [(12.0, 8.0, 11.0, 0.0)] and out.count() == 6
    assert cl.clean_stock_data(df, missing="drop", tie=["open"]).count() == 5
    with pytest.raises(ValueError):
        cl.clean_stock_data(df, missing="guess", tie=["open"])


def test_unreadable_dates_are_set_aside(spark):
    good, bad = cl.coerce_dates(spark.createDataFrame([("2020-01-05",), ("soon",)], "date string"))
    assert good.first().date == dt.date(2020, 1, 5) and bad.count() == 1


def test_nearest_takes_later_date_on_tie(spark):
    left = frame(spark, [("a", d, 0.0) for d in (0, 2, 3, 4, 5, 9)])
    right = frame(spark, [("t", 1, 10.0), ("t", 5, 50.0)]).select("date", F.col("x").alias("v"))
    for block in (2, None):
        assert values(nearest_by_date(left, right, "v", block_rows=block), "v") == [10.0, 10.0, 50.0, 50.0, 50.0, 50.0]
