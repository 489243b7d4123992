"""Whole batches: order of trimming and signals, and windows that shrink with the history."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import stationarity as st
from tidemark.operators import trend as tr
from tidemark.plans import batches as ba

SMALL = {"sma": [5, 20], "ema": [5], "bb": [20], "rsi": [14], "macd": [(12, 26, 9)], "stoch": [(14, 3)], "adx": [14], "atr": [14]}


def test_signals_see_the_trimmed_series(walk):
    _, df = walk
    out = ba.technical_indicators(df.where("symbol = 'B'"), SMALL, signals=True, trim=50, block_rows=90).orderBy("date").toPandas()
    assert len(out) == 210
    rsi = out["rsi_14"]
    want = ((rsi > 30) & (rsi.shift(1) <= 30)).astype(int)
    pd.testing.assert_series_equal(out["rsi_bull_cross"].astype(int), want, check_names=False, check_dtype=False)
    sma, close = out["sma_20"], out["close"]
    up = ((close > sma) & (sma > sma.shift(1))).astype(int)
    down = ((close < sma) & (sma < sma.shift(1))).astype(int)
    assert (out["trend_label"] == up - down).all() and out["trend_label"].iat[0] == 0
    assert {"macd_hist_12_26_9", "combined_signal", "volatility_20d", "cumulative_return"} <= set(out.columns)


def test_windows_shrink_with_history(spark):
    days = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    df = spark.range(100).select(F.lit("long").alias("symbol"), days.alias("date"), F.col("id").cast("double").alias("close"))
    df = df.unionByName(df.where("close < 40").withColumn("symbol", F.lit("short"))).unionByName(df.where("close < 3").withColumn("symbol", F.lit("tiny")))
    got = tr.slopes(df, tr.Share(20, 4))
    assert {(r.symbol, r.window) for r in got.collect()} == {("long", 20), ("long", 40), ("long", 80), ("short", 10), ("short", 20)}


@pytest.fixture(scope="module")
def lengths(spark):
    """Series of 5 to 300 rows, one of them with the most rows; each length has its own window."""
    rng = np.random.default_rng(11)
    frames = []
    for n in (5, 8, 11, 13, 24, 37, 52, 61, 79, 80, 99, 119, 150, 203, 269, 300):
        days = pd.Timestamp("2010-01-04") + pd.to_timedelta(np.cumsum(rng.integers(1, 3, n)), unit="D")
        saw = 20 * np.abs((np.arange(n) % 30) / 15 - 1)
        frames.append(pd.DataFrame({"symbol": f"s{n:03}", "date": days.date, "close": np.round(100 + saw + rng.normal(0, 0.4, n), 3)}))
    return spark.createDataFrame(pd.concat(frames, ignore_index=True), "symbol string, date date, close double").cache()


#: name -> (operator over (rows, window), window)
BY_SHARE = {
    "slopes": (lambda d, w: tr.slopes(d, w).drop("windows"), tr.Share(20, 4)),
    "summary": (tr.series_summary, tr.Share(20, 4)),
    "direction": (lambda d, w: tr.direction_summary(d, w).withColumn("slopes", F.to_json("slopes")).drop("slopes"), tr.Share(20, 4)),
    "changes": (lambda d, w: tr.trend_changes(d, w, digits=8), tr.Share(20, 4)),
    "levels": (tr.support_resistance, tr.Share(20, 5)),
    "phase": (lambda d, w: tr.market_phase(tr.phase_inputs(d, w)), tr.Share(90, 3)),
    "envelope": (st.rolling_envelope, tr.Share(30, 4)),
}


@pytest.mark.parametrize("name", BY_SHARE)
def test_a_share_is_each_series_own_window(spark, lengths, name):
    """One plan for all lengths against one fixed-window run per series."""
    operator, share = BY_SHARE[name]
    sizes = {r.symbol: r["count"] for r in lengths.groupBy("symbol").count().collect()}
    want = []
    for symbol, n in sizes.items():
        w = min(share.full, n // share.share)
        if w >= share.least:
            want += operator(lengths.where(F.col("symbol") == symbol), w).collect()
    got = operator(lengths, share).collect()
    assert len(want) > 3 and got[0].asDict().keys() == want[0].asDict().keys()
    order = lambda r: (r.symbol, *[str(r[c]) for c in ("window", "pos") if c in r])
    for g, w in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        for column, value in w.asDict().items():
            assert g[column] == (pytest.approx(value, rel=1e-7, abs=1e-8) if isinstance(value, float) else value), (g.symbol, column)


def test_the_trend_batch_plans_do_not_grow_with_the_lengths(spark, lengths):
    """As many scans for sixteen lengths as for one."""
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    one = ba.trend_batch(lengths.where("symbol = 's300'"))
    assert {name: leaves(df) for name, df in ba.trend_batch(lengths).items()} == {name: leaves(df) for name, df in one.items()}

def test_coin_batch_columns(spark):
    days = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    coins = spark.range(260).select(F.lit("c").alias("symbol"), days.alias("date"), (100 + 20 * F.sin(F.col("id") / 9)).alias("price"),
                                    F.lit(1000.0).alias("market_cap"), (F.col("id") % 7 + 1).cast("double").alias("volume"))
    out = ba.crypto_batch(coins, coins.where("weekday(date) = 0").select("date", F.lit(4000.0).alias("total_market_cap")))
    row = out.orderBy(F.desc("date")).first()
    assert out.count() == 60 and row.market_dominance == 25.0 and row.symbol == "c"
    wanted = {"ema_100", "bb_width", "volatility_90d", "hist_volatility_30d", "norm_range_7d_avg", "roc_90d", "return_90d", "nvt_signal", "obv", "volume_ratio", "cmf_20",
              "golden_cross", "trend", "local_bottom", "rolling_max", "accumulation_phase", "bubble_indicator", "market_cycle_label"}
    assert wanted <= set(out.columns)
    assert out.where("rolling_max < close").count() == 0
