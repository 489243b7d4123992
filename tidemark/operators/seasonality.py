"""Autocorrelation, calendar effects and seasonal decomposition."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators.series import BLK, KEYS, RN, Step, compute, lay_out
from tidemark.operators.trend import find_peaks, with_length
from tidemark.session import staged

MAX_LAG = 365
BLOCK_ROWS_FOR_LAGS = 32768


def lag_sums(df: DataFrame, column: str, max_lag: int, keys: Sequence[str] = KEYS, order: str = "date", block_rows: int | None = None) -> DataFrame:
    """Per series and lag the sums a correlation of ``x(t)`` with ``x(t - lag)`` needs, and ``rows``.

    Each block, with ``max_lag`` rows of margin, gives one row per lag; no row is repeated per lag.
    Values are centred on the series mean.
    """
    keys = list(keys)
    s = lay_out(df.select(*keys, order, column), max_lag, 0, keys, order, block_rows or BLOCK_ROWS_FOR_LAGS)
    s = s.join_series(F.avg(column).alias("_mean"), F.max(RN).alias("_len"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in keys)
    block = s.block

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(RN)
        x = (pdf[column] - pdf["_mean"]).to_numpy(float)
        start = int(((pdf[RN].to_numpy() - 1) // block < pdf[BLK].iat[0]).sum())  # margin rows
        rows = []
        for lag in range(1, min(max_lag, int(pdf["_len"].iat[0]) - 1) + 1):
            a = max(start, lag)
            if a >= len(x):
                continue
            now, then = x[a:], x[a - lag: len(x) - lag]
            rows.append((lag, len(now), now.sum(), then.sum(), now @ now, then @ then, now @ then))
        out = pd.DataFrame(rows, columns=["lag", "n", "sx", "sy", "sxx", "syy", "sxy"])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iat[0])
        out["rows"] = int(pdf["_len"].iat[0])
        return out

    parts = s.df.groupBy(*keys, BLK).applyInPandas(
        sums, f"{kinds}, lag int, n long, sx double, sy double, sxx double, syy double, sxy double, rows long")
    return parts.groupBy(*keys, "lag").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")], F.max("rows").alias("rows"))


def _lag_corr() -> Column:
    n = F.col("n")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    return ratio(n * F.col("sxy") - F.col("sx") * F.col("sy"), F.sqrt(F.greatest(vx * vy, F.lit(0.0))))


def returns_of(df: DataFrame, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    step = Step(lambda s: s.add({"ret": ratio(F.col(column), s.lag(column)) - 1}), 1)
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    return compute(known, step, keys=keys, order=order).where("ret is not null").select(*keys, order, "ret")


def autocorrelation(df: DataFrame, column: str = "close", max_lag: int = MAX_LAG, keys: Sequence[str] = KEYS, order: str = "date", block_rows: int | None = None) -> DataFrame:
    """Of the levels, for lags 1 … min(rows / 3, max_lag): ``(…, lag, acf, rows)``."""
    known = df.where(F.col(column).isNotNull())
    sums = lag_sums(known, column, max_lag, keys, order, block_rows)
    return sums.where(F.col("lag") <= F.floor(F.col("rows") / 3)).select(*keys, "lag", _lag_corr().alias("acf"), "rows")


def return_autocorrelation(df: DataFrame, column: str = "close", max_lag: int = MAX_LAG, keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Of the returns; series under 1.5 ``max_lag`` use a third of their length, under 30 rows none."""
    sums = lag_sums(returns_of(df, column, keys, order), "ret", max_lag, keys, order)
    levels = F.col("rows") + 1
    top = F.when(levels < max_lag * 1.5, F.floor(levels / 3)).otherwise(max_lag)
    limit = F.least(top + 1, F.floor(F.col("rows") / 3))
    return sums.where((levels >= 30) & (F.col("lag") < limit)).select(*keys, "lag", _lag_corr().alias("acf"), "rows")


def seasonal_periods(df: DataFrame, column: str = "close", max_lag: int = MAX_LAG, height: float = 0.1, keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Peaks of the return autocorrelation beyond the 95 % bound, most significant first."""
    acf = return_autocorrelation(df, column, max_lag, keys, order)
    peaks = find_peaks(acf, keys, "lag", "acf", height, 5)
    rows = acf.groupBy(*keys).agg(F.max("rows").alias("rows"))
    bound = 1.96 / F.sqrt("rows")
    found = peaks.join(rows, [*keys]).where(F.abs("acf") > bound).withColumn("significance", F.abs("acf") / bound)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("significance"), "lag"))
    return found.select(*keys, F.col("lag").alias("period"), F.col("acf").alias("correlation"), "significance", rank.alias("rank"))


def detect_period(df: DataFrame, column: str = "close", default: int = 30, keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Lag of the first autocorrelation peak of the levels, else ``default``."""
    acf = autocorrelation(df, column, MAX_LAG, keys, order)
    first = find_peaks(acf, keys, "lag", "acf", 0.1, 5).groupBy(*keys).agg(F.min("lag").alias("_p"))
    every = df.select(*keys).distinct()
    return every.join(first, [*keys], "left").select(*keys, F.coalesce("_p", F.lit(default)).alias("period"))


#: Smallest spread between best and worst mean return that counts as a pattern.
CALENDAR_THRESHOLDS = {"weekday": 0.001, "month": 0.01, "quarter": 0.01}


def calendar_means(df: DataFrame, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Mean return by weekday (Monday 0), month and quarter in one pass."""
    parts = F.array(
        F.struct(F.lit("weekday").alias("calendar"), F.weekday(order).alias("part")),
        F.struct(F.lit("month").alias("calendar"), F.month(order).alias("part")),
        F.struct(F.lit("quarter").alias("calendar"), F.quarter(order).alias("part")))
    rows = returns_of(df, column, keys, order).select(*keys, "ret", F.explode(parts).alias("p"))
    return rows.groupBy(*keys, "p.calendar", "p.part").agg(F.avg("ret").alias("mean_return"))


def calendar_patterns(means: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Best and worst part and the spread in standard deviations, where the spread is large enough."""
    best, worst = F.max("mean_return"), F.min("mean_return")
    out = means.groupBy(*keys, "calendar").agg(
        F.max_by("part", F.struct("mean_return", -F.col("part"))).alias("best"),
        F.min_by("part", F.struct("mean_return", "part")).alias("worst"),
        (best - worst).alias("spread"), F.stddev_samp("mean_return").alias("_dev"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("part", "mean_return")))).alias("returns"))  # ≤ 12 parts
    limit = F.lit(None).cast("double")
    for name, value in CALENDAR_THRESHOLDS.items():
        limit = F.when(F.col("calendar") == name, value).otherwise(limit)
    return out.where(F.col("spread") > limit).withColumn("significance", ratio(F.col("spread"), F.col("_dev"))).drop("_dev")


def _centred(column: str, keys: Sequence[str], period: Column, half: Column) -> Column:
    """Centred average over a window that differs from series to series.

    Frames have constant bounds, so the order is scaled instead: rows up to ``half`` away lie less than 1 apart when row
    numbers are divided by ``half + 1/2``. The outer rows of an even period count half.
    """
    frame = Window.partitionBy(*keys, BLK).orderBy(F.col(RN) / (half + 0.5)).rangeBetween(-1, 1)
    ends = (F.first(column).over(frame) + F.last(column).over(frame)) / 2
    total = F.sum(column).over(frame)
    return F.when(period % 2 == 1, total / period).otherwise((total - ends) / period)


def seasonality_flags(periods: DataFrame, patterns: DataFrame, series: DataFrame, least: int = 30, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per series of at least ``least`` rows: whether it has a significant period, how many, and which calendar patterns.

    ``periods`` and ``patterns`` come from :func:`seasonal_periods` and :func:`calendar_patterns`, ``series`` is the data.
    """
    keys = list(keys)
    every = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(*keys)
    found = periods.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_periods"), F.min_by("period", "rank").alias("strongest_period"))
    shown = patterns.groupBy(*keys).agg(*[
        F.max(F.col("calendar") == name).alias(f"{name}_pattern") for name in CALENDAR_THRESHOLDS])
    out = every.join(found, keys, "left").join(shown, keys, "left")
    return out.select(*keys, F.col("n_periods").isNotNull().alias("has_significant_seasonality"), F.coalesce("n_periods", F.lit(0)).alias("n_periods"), "strongest_period",
                      *[F.coalesce(f"{name}_pattern", F.lit(False)).alias(f"{name}_pattern") for name in CALENDAR_THRESHOLDS])


def decompose(df: DataFrame, period: int | None = None, model: str = "additive", column: str = "close", keys: Sequence[str] = KEYS, order: str = "date",
              block_rows: int | None = None) -> DataFrame:
    """Trend by centred average (ends by a line through the nearest ``period`` points), seasonal, residual.

    Without a ``period`` each series takes the one :func:`detect_period` finds in it, given as a column; all of
    them are one plan. Series shorter than two periods are left out.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown model {model}")
    keys = list(keys)
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    if period is None:
        known = staged(known)
        margin = MAX_LAG // 2
        s = lay_out(known, margin, margin, keys, order, block_rows).join_per_series(detect_period(known, column, keys=keys, order=order))
        period, half = F.col("period"), F.floor(F.col("period") / 2)
        s = with_length(s)
        mean = _centred(column, keys, period, half)
    else:
        half = period // 2
        s = with_length(lay_out(known, half, half, keys, order, block_rows))
        if period % 2:
            mean = F.avg(column).over(s.over(-half, half))
        else:
            ends = (F.lag(column, half).over(s.over()) + F.lead(column, half).over(s.over())) / 2
            mean = (F.coalesce(F.sum(column).over(s.over(-half + 1, half - 1)), F.lit(0.0)) + ends) / period
    inside = (F.col(RN) > half) & (F.col(RN) <= F.col("_len") - half)
    s = s.add({"trend": F.when(inside, mean)})
    head = F.col("trend").isNotNull() & (F.col(RN) <= half + period)
    foot = F.col("trend").isNotNull() & (F.col(RN) > F.col("_len") - half - period)
    lines = s.core().groupBy(*keys).agg(*[
        fit(F.when(part, F.col("trend")), F.col(RN)).alias(f"_{tag}_{name}")
        for tag, part in (("h", head), ("f", foot)) for name, fit in (("k", F.regr_slope), ("c", F.regr_intercept))])
    s = s.join_per_series(lines)
    line = F.when(F.col(RN) <= half, F.col("_h_c") + F.col("_h_k") * F.col(RN)).otherwise(F.col("_f_c") + F.col("_f_k") * F.col(RN))
    s = s.add({"trend": F.coalesce("trend", line), "_phase": ((F.col(RN) - 1) % period).cast("int")}).drop("_h_k", "_h_c", "_f_k", "_f_c")
    plain = F.col(column) - F.col("trend") if model == "additive" else ratio(F.col(column), F.col("trend"))
    s = s.add({"_plain": plain})
    phases = s.core().groupBy(*keys, "_phase").agg(F.avg("_plain").alias("v"))
    table = phases.groupBy(*keys).agg(F.avg("v").alias("_centre"), F.map_from_entries(F.collect_list(F.struct("_phase", "v"))).alias("_by"))  # one entry per phase
    s = s.join_per_series(table)
    mine = F.try_element_at("_by", F.col("_phase"))
    seasonal = mine - F.col("_centre") if model == "additive" else ratio(mine, F.col("_centre"))
    s = s.add({"seasonal": seasonal})
    left = F.col("_plain") - F.col("seasonal") if model == "additive" else ratio(F.col("_plain"), F.col("seasonal"))
    s = s.add({"residual": left})
    return s.rows().where(F.col("_len") >= 2 * period).drop("_len", "_phase", "_plain", "_centre", "_by")
