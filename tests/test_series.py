"""Numbering, blocks, running values, exponential scans and quantiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators import signals as sig
from tidemark.operators.series import compute, exact_quantiles, lay_out, memory, with_ordinal


def by_row(df, *columns):
    return df.select("symbol", "date", *columns).orderBy("symbol", "date").toPandas().reset_index(drop=True)


def test_ordinal_counts_each_series(walk):
    pdf, df = walk
    got = by_row(with_ordinal(df, out="rn"), "rn")
    want = pdf.sort_values(["symbol", "date"]).groupby("symbol").cumcount() + 1
    assert got["rn"].tolist() == want.tolist()


@pytest.mark.parametrize("span", [2, 7, 26, 200])
@pytest.mark.parametrize("block", [64, None])
def test_ema_matches_pandas(walk, span, block):
    pdf, df = walk
    got = by_row(compute(df, ind.ema(span, out="e"), block_rows=block), "e")
    want = pdf.sort_values(["symbol", "date"]).groupby("symbol")["close"].transform(
        lambda x: x.ewm(span=span, adjust=False).mean().where(np.arange(len(x)) >= span - 1))
    np.testing.assert_allclose(got["e"], want, rtol=1e-11)


def test_span_one_is_identity(walk):
    _, df = walk
    assert compute(df, ind.ema(1, out="e")).where("e <> close").count() == 0


def test_fast_decay_spans_parts(spark):
    """More rows in a block than the weights allow: the origin has to move."""
    n = 3000
    df = spark.range(n).select(F.lit("x").alias("symbol"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                               (F.sin("id") + 5).alias("close"))
    got = by_row(compute(df, ind.ema(2, out="e")), "e")["e"]
    want = pd.Series(np.sin(np.arange(n)) + 5).ewm(span=2, adjust=False).mean()
    np.testing.assert_allclose(got[1:], want[1:], rtol=1e-11)


def every_step():
    first = [ind.sma(20), ind.bollinger(20, pct_b="pb", width="bw"), ind.rsi(14), ind.macd(), ind.stochastic(), ind.adx(5), ind.atr(14), ind.obv(), ind.cci(20),
             ind.williams_r(), ind.roc(10), ind.mfi(), ind.ichimoku(), ind.daily_return(), ind.cumulative_return(), ind.log_return(), ind.period_return(30),
             ind.normalized_range(), ind.volume_ratio(), ind.chaikin_flow(), ind.drawdown(), sig.local_extrema()]
    return first, [ind.volatility(20), sig.macd_cross(), sig.rsi_signals(), sig.bollinger_signals(), sig.stochastic_signals(), sig.trend_label()], [sig.combined_signal()]


def test_blocks_do_not_change_results(walk):
    """Small blocks, other partitioning and row order give what one block per series gives."""
    _, df = walk
    whole = compute(df, *every_step(), block_rows=10**6)
    cut = compute(df.repartition(7).orderBy(F.rand(3)), *every_step(), block_rows=150)
    names = [c for c in whole.columns if c not in ("symbol", "date")]
    a, b = by_row(whole, *names), by_row(cut, *names)
    assert len(a) == len(b) == 1800
    for c in names:
        np.testing.assert_allclose(b[c].astype(float), a[c].astype(float), rtol=1e-8, atol=1e-8, err_msg=c)


def test_one_series_alone_gives_the_same(walk):
    _, df = walk
    step = [ind.rsi(14), ind.sma(20), ind.drawdown()]
    alone = by_row(compute(df.where("symbol = 'B'"), step), "rsi_14", "sma_20", "rolling_max")
    among = by_row(compute(df, step).where("symbol = 'B'"), "rsi_14", "sma_20", "rolling_max")
    pd.testing.assert_frame_equal(alone, among)
    assert among["rsi_14"].dropna().between(0, 100).all()


def test_running_total_and_maximum(walk):
    pdf, df = walk
    s = lay_out(df, block_rows=97).running(F.sum, {"total": "volume"}, lambda x, y: x + y).running(F.max, {"top": "close"}, F.greatest)
    got = by_row(s.rows(), "total", "top")
    g = pdf.sort_values(["symbol", "date"]).groupby("symbol")
    np.testing.assert_allclose(got["total"], g["volume"].cumsum())
    np.testing.assert_allclose(got["top"], g["close"].cummax())


@pytest.mark.parametrize("accuracy", [20000, 100])
def test_quantiles_are_exact(walk, accuracy):
    pdf, df = walk
    probabilities = (0.0025, 0.05, 0.5, 0.85, 0.95, 0.9975)
    got = exact_quantiles(df, ["close", "volume"], probabilities, accuracy=accuracy).toPandas().set_index("symbol")
    for symbol, part in pdf.groupby("symbol"):
        for c in ("close", "volume"):
            for i, p in enumerate(probabilities):
                assert got.loc[symbol, f"{c}_q{i}"] == pytest.approx(np.quantile(part[c], p), rel=1e-12), (symbol, c, p)


def test_quantiles_with_one_dominant_value(spark):
    df = spark.range(3000).select(F.lit("x").alias("symbol"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                  F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    values = [7.0 if i % 3 == 0 else float(i) for i in range(3000)]
    got = exact_quantiles(df, ["v"], (0.05, 0.2, 0.95), accuracy=200).first()
    assert [got.v_q0, got.v_q1, got.v_q2] == pytest.approx(list(np.quantile(values, (0.05, 0.2, 0.95))))


def test_memory_reaches_double_precision():
    assert 0.9 ** memory(0.9) <= 1e-18 < 0.9 ** (memory(0.9) - 1)
    assert memory(0) == 1


def test_windows_share_one_exchange(walk):
    """All bounded indicators run on the layout's exchange; none adds its own."""
    _, df = walk
    plan = compute(df, [ind.sma(20), ind.ema(12), ind.rsi(14), ind.bollinger(20)])._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.splitlines() if "hashpartitioning(symbol" in line and "_blk" in line]
    assert len(keyed) == 1, plan
