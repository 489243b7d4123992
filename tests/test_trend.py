"""Trend, level, seasonality and stationarity operators against direct computation."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import seasonality as se
from tidemark.operators import stationarity as st
from tidemark.operators import trend as tr


def line(spark, values, symbol="s"):
    days = pd.date_range("2010-01-01", periods=len(values)).date
    return spark.createDataFrame([(symbol, d, None if v is None else float(v)) for d, v in zip(days, values)], "symbol string, date date, close double")


def test_ramp_slopes(spark):
    rows = {r.window: r for r in tr.slopes(line(spark, range(1, 31)), 5, smooth=False).collect()}
    assert set(rows) == {5, 10, 20}
    for w, r in rows.items():
        assert r.slope == pytest.approx(1) and r.r_squared == pytest.approx(1) and r.direction == "uptrend"
        assert r.normalized_slope == pytest.approx(100 / (31 - w))


def test_short_series_are_left_out(spark):
    df = line(spark, [1, 2, 3])
    assert tr.direction_summary(df).count() == 0 and tr.support_resistance(df).count() == 0
    assert tr.phase_inputs(df).count() == 0 and st.rolling_envelope(df).count() == 0 and se.decompose(df, 2 * 3).count() == 0


def brute_peaks(y, height, distance):
    n, tops, i = len(y), [], 1
    while i < n - 1:
        j = i
        while j < n - 1 and y[j + 1] == y[i]:
            j += 1
        if y[i - 1] < y[i] and j < n - 1 and y[j + 1] < y[i]:
            tops.append((i + j) // 2)
        i = j + 1
    kept = []
    for p in sorted((p for p in tops if y[p] >= height), key=lambda p: (-y[p], -p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    return sorted(kept)


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_find_peaks(spark, distance):
    y = np.random.default_rng(distance).integers(0, 6, 80)
    df = spark.createDataFrame([("s", i, int(v)) for i, v in enumerate(y)], "symbol string, i int, y int")
    got = sorted(r.i for r in tr.find_peaks(df, ["symbol"], "i", "y", 2, distance).collect())
    assert got == brute_peaks(y, 2, distance)


def brute_changes(x, w, threshold):
    rows = []
    t = np.arange(w)
    fit = lambda y: (np.polyfit(t, y, 1)[0] / y.mean(), np.corrcoef(t, y)[0, 1])
    for i in range(w, len(x) - w + 1):
        (s1, r1), (s2, r2) = fit(x[i - w:i]), fit(x[i:i + w])
        rows.append((i, s1, s2, r1, r2, abs(s2 - s1) / (abs(s1) + 1e-10)))
    kept = []
    for prev, cur in itertools.pairwise(rows):
        i, s1, s2, r1, r2, m = cur
        if (s2 * prev[2] < 0 or m > threshold) and r1 * r1 > 0.6 and r2 * r2 > 0.6:
            if not kept or i - kept[-1][0] > w / 2:
                kept.append((i, m))
            elif m > kept[-1][1]:
                kept[-1] = (i, m)
    return kept


@pytest.mark.parametrize("block", [64, None])
def test_trend_changes(spark, block):
    rng = np.random.default_rng(5)
    x = 200 + np.cumsum(np.repeat(rng.normal(size=20), 25)) + rng.normal(scale=0.3, size=500)
    want = brute_changes(x, 10, 0.15)
    got = tr.trend_changes(line(spark, x), 10, 0.15, block_rows=block).orderBy("pos").collect()
    assert len(want) > 5
    assert [r.pos - 1 for r in got] == [i for i, _ in want]
    assert [r.magnitude for r in got] == pytest.approx([m for _, m in want], rel=1e-6)


def test_histogram_matches_numpy(spark):
    x = np.round(np.random.default_rng(1).normal(50, 5, 400), 2)
    recent = tr.recent_rows(line(spark, x), 20)
    got = tr.price_histogram(recent).orderBy("bin").toPandas()
    counts, edges = np.histogram(x[-200:], bins=40)
    assert got["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["center"], (edges[:-1] + edges[1:]) / 2)


def test_best_split_is_optimal():
    rng = np.random.default_rng(2)
    for k in (1, 2, 3):
        v = np.sort(rng.normal(size=9))
        options = []
        for cuts in itertools.combinations(range(1, 9), k - 1):
            parts = np.split(v, cuts)
            options.append((sum(((p - p.mean()) ** 2).sum() for p in parts), [p.mean() for p in parts]))
        assert tr._best_split(rng.permutation(v), k) == pytest.approx(min(options)[1])


def test_support_resistance_sides(spark):
    x = 100 + 10 * np.sin(np.arange(300) / 3) + 0.01 * np.arange(300)
    r = tr.support_resistance(line(spark, x), 10).first()
    assert r.closest_support is None or r.closest_support < r.price
    assert r.closest_resistance is None or r.closest_resistance > r.price
    assert len(r.peaks_supports) == len(r.peaks_resistances) == 3
    assert r.peaks_supports == sorted(r.peaks_supports, reverse=True)


@pytest.mark.parametrize("block", [50, None])
def test_autocorrelation(spark, block):
    x = np.random.default_rng(4).normal(size=300).cumsum()
    got = {r.lag: r.acf for r in se.autocorrelation(line(spark, x), max_lag=80, block_rows=block).collect()}
    assert sorted(got) == list(range(1, 81))
    for lag in (1, 7, 80):
        assert got[lag] == pytest.approx(pd.Series(x).autocorr(lag), abs=1e-10)


def test_period_of_a_sine_is_found(spark):
    df = line(spark, np.sin(np.arange(200) * 2 * np.pi / 25)).unionByName(line(spark, np.arange(60), "ramp"))
    got = {r.symbol: r.period for r in se.detect_period(df).collect()}
    assert got == {"s": 25, "ramp": 30}


@pytest.mark.parametrize("period", [5, 6])
@pytest.mark.parametrize("model", ["additive", "multiplicative"])
def test_decompose(spark, period, model):
    rng = np.random.default_rng(8)
    n = 83
    x = 50 + 0.3 * np.arange(n) + np.tile(rng.normal(size=period), n)[:n] + rng.normal(scale=0.1, size=n)
    got = se.decompose(line(spark, x), period, model, block_rows=20).orderBy("date").toPandas()
    half = period // 2
    kernel = np.ones(period) / period if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    trend[half:n - half] = np.convolve(x, kernel, "valid")
    t = np.arange(n)
    for ends, fit in ((t[:half], t[half:half + period]), (t[n - half:], t[n - half - period:n - half])):
        trend[ends] = np.polyval(np.polyfit(fit, trend[fit], 1), ends)
    plain = x - trend if model == "additive" else x / trend
    by = np.array([plain[i::period].mean() for i in range(period)])
    by = by - by.mean() if model == "additive" else by / by.mean()
    seasonal = by[t % period]
    np.testing.assert_allclose(got["trend"], trend)
    np.testing.assert_allclose(got["seasonal"], seasonal, atol=1e-10)
    np.testing.assert_allclose(got["residual"], plain - seasonal if model == "additive" else plain / seasonal, atol=1e-10)


def direct_adf(x):
    n = len(x)
    top = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))
    d = np.diff(x)

    def fit(k, first):
        t = np.arange(first, n - 1)
        a = np.column_stack([x[t], np.ones(len(t)), *[d[t - j] for j in range(1, k + 1)]])
        b, *_ = np.linalg.lstsq(a, d[t], rcond=None)
        e = d[t] - a @ b
        sse, m = e @ e, len(t)
        se_ = math.sqrt(sse / (m - a.shape[1]) * np.linalg.inv(a.T @ a)[0, 0])
        return m * (math.log(2 * math.pi) + math.log(sse / m) + 1) + 2 * a.shape[1], b[0] / se_

    best = min(range(top + 1), key=lambda k: fit(k, top)[0])
    return best, fit(best, best)[1]


@pytest.mark.parametrize("kind", ["noise", "walk", "ar2"])
@pytest.mark.parametrize("block", [60, None])
def test_adf(spark, kind, block):
    e = np.random.default_rng(6).normal(size=350)
    x = {"noise": e, "walk": e.cumsum(), "ar2": pd.Series(e).ewm(alpha=0.4).mean().ewm(alpha=0.5).mean().to_numpy()}[kind]
    lag, stat = direct_adf(x)
    r = st.adf(line(spark, x), block_rows=block).first()
    assert (r.used_lag, r.n) == (lag, 350) and r.statistic == pytest.approx(stat, rel=1e-8)
    assert r.is_stationary == (r.p_value < 0.05) and (kind != "noise" or r.p_value < 1e-6)


def test_adf_p_values_agree_with_critical_values():
    for name, level in (("1%", 0.01), ("5%", 0.05), ("10%", 0.10)):
        assert st.adf_p_value(st.ADF_CRITICAL[name][0]) == pytest.approx(level, rel=0.03)


def test_kpss(spark):
    for x in (np.random.default_rng(9).normal(size=300), np.random.default_rng(9).normal(size=300).cumsum()):
        n, r = len(x), x - x.mean()
        first = int(n ** (2 / 9))
        g = lambda k: r[k:] @ r[:n - k]
        s0 = (r @ r) / n + sum(g(k) / (n / 2) for k in range(1, first + 1))
        s1 = sum(k * g(k) / (n / 2) for k in range(1, first + 1))
        lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
        want = (r.cumsum() ** 2).sum() / n**2 / ((r @ r + 2 * sum(g(k) * (1 - k / (lags + 1)) for k in range(1, lags + 1))) / n)
        got = st.kpss(line(spark, x)).first()
        assert got.lags == lags and got.statistic == pytest.approx(want)
        assert got.p_clipped == (not 0.347 <= want <= 0.739)


def test_calendar_means(spark):
    x = 100 + np.random.default_rng(10).normal(size=400)
    df = line(spark, x)
    r = pd.Series(x).pct_change()
    days = pd.date_range("2010-01-01", periods=400)
    got = {(g.calendar, g.part): g.mean_return for g in se.calendar_means(df).collect()}
    for name, key in (("weekday", days.dayofweek), ("month", days.month), ("quarter", days.quarter)):
        for part, value in r.groupby(key).mean().items():
            assert got[name, part] == pytest.approx(value)
    top = {p.calendar: p for p in se.calendar_patterns(se.calendar_means(df)).collect()}
    assert top["weekday"].best == r.groupby(days.dayofweek).mean().idxmax()


def test_market_phase_order(spark):
    base = dict(drawdown_from_ath=-35.0, recent_return=-25.0, volatility_ratio=1.6, long_term_slope=-0.1, rsi=20.0)
    cases = [(base, "bearish_trend"), ({**base, "long_term_slope": 0.1}, "capitulation"), ({**base, "rsi": None}, "indeterminate"),
             (dict(drawdown_from_ath=-25.0, recent_return=1.0, volatility_ratio=0.5, long_term_slope=0.0, rsi=50.0), "accumulation"),
             (dict(drawdown_from_ath=-5.0, recent_return=1.0, volatility_ratio=0.5, long_term_slope=0.0, rsi=50.0), "sideways")]
    df = spark.createDataFrame([(i, *c.values()) for i, (c, _) in enumerate(cases)], "i int, " + ", ".join(f"{k} double" for k in base))
    assert [r.current_phase for r in tr.market_phase(df).orderBy("i").collect()] == [name for _, name in cases]


def test_ema_class_of_a_ramp(spark):
    up, down = line(spark, range(60), "up"), line(spark, range(60, 0, -1), "down")
    got = {r.symbol: r.ema_trend for r in tr.ema_order(up.unionByName(down)).collect()}
    assert got == {"up": "strong_uptrend", "down": "strong_downtrend"}
    assert tr.series_summary(up.where(F.col("close") > 0)).first().overall_change_pct == pytest.approx(5800)
