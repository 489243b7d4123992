"""Unit-root and stationarity tests. Heavy sums run in blocks; a small solve runs per series."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators import indicators as ind
from tidemark.operators.seasonality import BLOCK_ROWS_FOR_LAGS, lag_sums
from tidemark.operators.series import BLK, KEYS, RN, Step, compute, lay_out
from tidemark.operators.trend import Share, deviation_of, last_of, mean_of, wide_enough, window_of, with_length
from tidemark.session import staged

#: Published KPSS level-stationarity critical values and their p-values.
KPSS_CRITICAL = (0.347, 0.463, 0.574, 0.739)
KPSS_P = (0.10, 0.05, 0.025, 0.01)

#: MacKinnon's approximate p-value surface, constant only, and 2010 critical values.
ADF_STAR, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def kpss(df: DataFrame, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Statistic of the level residuals with Bartlett weights and data-driven lag count.

    ``p_clipped`` says that the statistic lies outside the published table. The lags that set the bandwidth
    are summed first (some per series: the length to the power 2/9), then as many as the bandwidth asks for.
    """
    keys = list(keys)
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    s = lay_out(known, keys=keys, order=order).join_series(F.avg(column).alias("_mean"))
    s = s.add({"_r": F.col(column) - F.col("_mean")})
    s = s.running(F.sum, {"_s": "_r"}, lambda a, b: a + b)
    base = s.core().groupBy(*keys).agg(
        F.max(RN).alias("n"), F.sum(F.col("_s") * F.col("_s")).alias("ss"), F.sum(F.col("_r") * F.col("_r")).alias("rr"))
    base = staged(base)
    n, lag = F.col("n"), F.col("lag")
    few = base.agg(F.coalesce(F.max(F.floor(F.pow(n.cast("double"), 2.0 / 9.0))), F.lit(0))).first()[0]
    joined = lag_sums(known, column, max(1, few), keys, order).select(*keys, "lag", "sxy").join(base, keys)
    first = F.when(lag <= F.floor(F.pow(n.cast("double"), 2.0 / 9.0)), F.col("sxy") / (n / 2))
    auto = joined.groupBy(*keys).agg(F.max("n").alias("n"), F.max("rr").alias("rr"), F.max("ss").alias("ss"),
                                     F.coalesce(F.sum(first), F.lit(0.0)).alias("s0"), F.coalesce(F.sum(first * lag), F.lit(0.0)).alias("s1"))
    shape = ratio(F.col("s1"), F.col("rr") / n + F.col("s0"))
    wanted = F.floor(1.1447 * F.pow(shape * shape, 1.0 / 3.0) * F.pow(n.cast("double"), 1.0 / 3.0))
    # without a single product (one row) the sums are empty, and so are the lags
    auto = staged(auto.withColumn("lags", F.least(wanted, n - 1)))
    most = auto.agg(F.coalesce(F.max("lags"), F.lit(0))).first()[0]
    if most > max(1, few):
        joined = lag_sums(known, column, most, keys, order).select(*keys, "lag", "sxy").join(base, keys)
    weighted = joined.join(auto.select(*keys, "lags"), keys).where("lag <= lags").groupBy(*keys).agg(
        F.sum(F.col("sxy") * (1 - lag / (F.col("lags") + 1))).alias("w"))
    out = auto.join(weighted, keys, "left")
    spread = (F.col("rr") + 2 * F.coalesce("w", F.lit(0.0))) / n
    out = out.select(*keys, "n", F.col("lags").cast("long").alias("lags"), ratio(F.col("ss") / (n * n), spread).alias("statistic"))
    x, p = F.col("statistic"), None
    for (x0, x1), (p0, p1) in zip(zip(KPSS_CRITICAL, KPSS_CRITICAL[1:]), zip(KPSS_P, KPSS_P[1:])):
        value = p0 + (x - x0) * ((p1 - p0) / (x1 - x0))
        p = F.when(x <= KPSS_CRITICAL[0], KPSS_P[0]).when(x <= x1, value) if p is None else p.when(x <= x1, value)
    out = out.withColumn("p_value", F.when(x.isNotNull(), p.otherwise(KPSS_P[-1])))
    clipped = (x < KPSS_CRITICAL[0]) | (x > KPSS_CRITICAL[-1])
    return out.withColumns({"p_clipped": clipped, "is_stationary": F.col("p_value") > 0.05})


def adf_lags(n: int) -> int:
    return max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))


def _design(y: np.ndarray, lags: int, first: int, last: int) -> np.ndarray:
    """Columns Δy(t), y(t-1), 1, Δy(t-1) … Δy(t-lags) for differences ``first`` … ``last - 1``."""
    d = np.diff(y)
    t = np.arange(first, last)
    return np.column_stack([d[t], y[t], np.ones(len(t)), *[d[t - k] for k in range(1, lags + 1)]])


def _least_squares(gram: np.ndarray, rows: int, k: int) -> tuple[float, float]:
    """Squared error, and t value of the level term, using the first ``k`` lagged differences."""
    use = np.arange(1, 3 + k)
    a, b = gram[np.ix_(use, use)], gram[use, 0]
    scale = np.sqrt(np.diag(a))
    inverse = np.linalg.pinv(a / np.outer(scale, scale)) / np.outer(scale, scale)
    beta = inverse @ b
    sse = max(gram[0, 0] - b @ beta, 0.0)
    error = math.sqrt(sse / (rows - len(use)) * inverse[0, 0]) if rows > len(use) else float("nan")
    return sse, beta[0] / error if error else float("nan")


def adf_p_value(stat: float) -> float:
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    powers = ADF_SMALL if stat <= ADF_STAR else ADF_LARGE
    z = sum(c * stat**i for i, c in enumerate(powers))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def adf(df: DataFrame, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date", block_rows: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag count by AIC.

    Blocks sum the cross products of the regressors; per series only that small matrix and the
    first few values reach the solve. The longest series sets the margin of the blocks.
    """
    keys = list(keys)
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    longest = adf_lags(known.groupBy(*keys).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]) + 1
    s = lay_out(known, longest + 1, 0, keys, order, block_rows or BLOCK_ROWS_FOR_LAGS)
    s = s.join_series(F.avg(column).alias("_mean"), F.max(RN).alias("_len"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in keys)
    block = s.block

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(RN)
        n, rn = int(pdf["_len"].iat[0]), pdf[RN].to_numpy()
        lags, y = adf_lags(n), (pdf[column] - pdf["_mean"]).to_numpy(float)
        # difference t joins rows t and t+1; it belongs to the block of row t+1
        mine = np.flatnonzero((rn[1:] - 1) // block == pdf[BLK].iat[0])
        mine = mine[rn[mine] > lags]
        cols = ["_len", "i", "j", "v", "head"]
        if not len(mine):
            out = pd.DataFrame([(n, 0, 0, 0.0, None)], columns=cols)
        else:
            z = _design(y, lags, mine[0], mine[-1] + 1)
            g = z.T @ z
            i, j = np.triu_indices(len(g))
            out = pd.DataFrame({"_len": n, "i": i, "j": j, "v": g[i, j], "head": None})
        if pdf[BLK].iat[0] == 0:
            out.loc[len(out)] = [n, 0, 0, 0.0, y[: lags + 2].tolist()]
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iat[0])
        return out

    parts = s.df.groupBy(*keys, BLK).applyInPandas(products, f"{kinds}, _len long, i int, j int, v double, head array<double>")
    summed = parts.groupBy(*keys, "_len", "i", "j").agg(F.sum("v").alias("v"), F.max("head").alias("head"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_len"].iat[0])
        lags = adf_lags(n)
        gram = np.zeros((lags + 3, lags + 3))
        for i, j, v in zip(pdf["i"], pdf["j"], pdf["v"]):
            gram[i, j] = gram[j, i] = v
        head = np.array(next(h for h in pdf["head"] if h is not None), dtype=float)
        rows = n - 1 - lags
        best, best_aic = 0, math.inf
        for k in range(lags + 1):
            sse, _ = _least_squares(gram, rows, k)
            aic = rows * (math.log(2 * math.pi) + math.log(max(sse, 1e-300) / rows) + 1) + 2 * (k + 2)
            if aic < best_aic:
                best, best_aic = k, aic
        extra = _design(head, best, best, lags)  # differences the longest lag had to skip
        full = gram[: best + 3, : best + 3] + extra.T @ extra
        used = n - 1 - best
        _, stat = _least_squares(full, used, best)
        p = adf_p_value(stat) if stat == stat else None
        row = {"n": n, "used_lag": best, "statistic": stat, "p_value": p}
        for name, (c0, c1, c2, c3) in ADF_CRITICAL.items():
            row[f"critical_{name[:-1]}"] = c0 + c1 / used + c2 / used**2 + c3 / used**3
        row["is_stationary"] = None if p is None else p < 0.05
        return pd.DataFrame([{**{k: pdf[k].iat[0] for k in keys}, **row}])

    return summed.groupBy(*keys).applyInPandas(
        solve, f"{kinds}, n long, used_lag int, statistic double, p_value double, critical_1 double, critical_5 double, critical_10 double, is_stationary boolean")


def rolling_envelope(df: DataFrame, window: int | Share = 30, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Range of the rolling mean and deviation, and their last value against row ``window + 1``."""
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    if isinstance(window, Share):
        def build(s):
            rows = last_of(s, column, window_of(window, F.col("_len")), window.full)
            return s.add({"_rows": rows}).add({"_m": mean_of(F.col("_rows")), "_d": deviation_of(F.col("_rows"))}).drop("_rows")

        out = compute(known, Step(with_length), Step(build, window.full - 1), keys=keys, order=order, keep_ordinal="rn")
    else:
        out = compute(known, [ind.sma(window, column, "_m"), ind.volatility(window, column, "_d")], keys=keys, order=order, keep_ordinal="rn")
        out = out.withColumn("_len", F.lit(0))
    then = F.col("rn") == window_of(window, F.col("_len")) + 1
    agg = out.groupBy(*keys).agg(
        F.max("rn").alias("n"), *[f(c).alias(f"{name}_{side}") for name, c in (("mean", "_m"), ("std", "_d")) for side, f in (("min", F.min), ("max", F.max))],
        *[F.max_by(c, "rn").alias(f"{c}_last") for c in ("_m", "_d")], *[F.max(F.when(then, F.col(c))).alias(f"{c}_then") for c in ("_m", "_d")])
    return agg.where((F.col("n") >= 2 * window_of(window, F.col("n"))) & wide_enough(window, F.col("n"))).select(
        *keys, "n", "mean_min", "mean_max", "std_min", "std_max",
        (ratio(F.col("_m_last"), F.col("_m_then")) - 1).alias("mean_change_pct"), (ratio(F.col("_d_last"), F.col("_d_then")) - 1).alias("std_change_pct"))


#: Wording of the joint verdict.
CONSENSUS = {
    (True, True): "Fuerte evidencia de estacionariedad",
    (True, False): "Evidencia mixta: posible tendencia",
    (False, True): "Evidencia mixta: posible estacionariedad con drift",
    (False, False): "Fuerte evidencia de no estacionariedad (serie con tendencia)",
}


def stationarity(df: DataFrame, window: int | Share = 30, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Both tests, their consensus and the rolling envelope for series of at least two windows."""
    a = adf(df, column, keys, order).select(*keys, *[F.col(c).alias(f"adf_{c}") for c in ("statistic", "p_value", "is_stationary")])
    k = kpss(df, column, keys=keys, order=order).select(*keys, *[F.col(c).alias(f"kpss_{c}") for c in ("statistic", "p_value", "is_stationary")])
    out = rolling_envelope(df, window, column, keys, order).join(a, [*keys], "left").join(k, [*keys], "left")
    verdict = F.lit(None).cast("string")
    for (x, y), text in CONSENSUS.items():
        verdict = F.when((F.col("adf_is_stationary") == x) & (F.col("kpss_is_stationary") == y), text).otherwise(verdict)
    return out.withColumn("consensus", verdict)
