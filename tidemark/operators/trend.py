"""Trend direction, trend changes, price levels and market phase of each series."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators import indicators as ind
from tidemark.operators.series import KEYS, RN, Series, Step, compute, lay_out
from tidemark.session import staged

# -- helpers -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Share:
    """A window that follows from a series' length: one ``share``-th of its rows, ``full`` at most.

    Series whose window would have fewer than ``least`` rows are left out. All series run in one plan: a frame
    of ``full`` rows is gathered per row, as long as a fixed window's frame would be, and cut to the row's own length.
    """

    full: int
    share: int
    least: int = 2


def window_of(window: int | Share, length: Column) -> Column:
    """A series' window, from the column that holds its length."""
    return F.least(F.lit(window.full), F.floor(length / window.share)).cast("int") if isinstance(window, Share) else F.lit(window)


def full_of(window: int | Share) -> int:
    return window.full if isinstance(window, Share) else window


def wide_enough(window: int | Share, length: Column) -> Column:
    return window_of(window, length) >= window.least if isinstance(window, Share) else F.lit(True)


def last_of(s: Series, column: str, size: Column, full: int) -> Column:
    """The last ``size`` values up to a row (at most ``full``), NULL where there are fewer. The column has no gaps."""
    got = F.collect_list(column).over(s.over(-(full - 1), 0))
    return F.when(F.size(got) >= size, F.slice(got, F.size(got) - size + 1, size))


def mean_of(values: Column) -> Column:
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), F.size(values))


def deviation_of(values: Column) -> Column:
    """Sample deviation, NULL for a single value."""
    mean = mean_of(values)
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.sqrt(F.try_divide(squares, F.size(values) - 1))


def line_of(values: Column, mean: Column) -> tuple[Column, Column]:
    """(slope, correlation) of values against their place; the correlation of a flat line is NULL."""
    n = F.size(values).cast("double")
    centre = (n - 1) / 2
    xy = F.aggregate(F.transform(values, lambda x, i: (x - mean) * (i - centre)), F.lit(0.0), lambda a, x: a + x)
    yy = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    xx = (n * n * n - n) / 12
    return F.try_divide(xy, xx), F.try_divide(xy, F.sqrt(xx * yy))


def with_length(s: Series, out: str = "_len") -> Series:
    return s.join_series(F.max(RN).alias(out))


def tail(df: DataFrame, rows: int | Column, column: str, keys: Sequence[str] = KEYS, order: str = "date", *steps: Step) -> DataFrame:
    """The last ``rows`` rows of each series, with ordinal ``rn`` and series length ``n``, which ``rows`` and the steps may use."""
    known = df.where(F.col(column).isNotNull())
    s = with_length(lay_out(known, sum(t.back for t in steps), 0, keys, order), "n")
    for t in steps:
        s = t.build(s)
    return s.rows("rn").where(F.col("rn") > F.col("n") - rows)


def find_peaks(df: DataFrame, keys: Sequence[str], pos: str, y: str, height: Column | float, distance: int) -> DataFrame:
    """Local maxima of a short sequence (lags or bins): ``(keys, pos, y)``.

    A flat top counts once, at its middle; ends do not count. Of two peaks closer than
    ``distance`` the higher stays, the later one on a tie.
    """
    keys = list(keys)
    line = Window.partitionBy(*keys).orderBy(pos)
    before = F.lag(y).over(line)
    runs = df.withColumn("_new", F.when(before.isNull() | (before != F.col(y)), 1).otherwise(0))
    runs = runs.withColumn("_run", F.sum("_new").over(line)).groupBy(*keys, "_run").agg(
        F.floor((F.min(pos) + F.max(pos)) / 2).cast(df.schema[pos].dataType).alias(pos), F.first(y).alias(y))
    rline = Window.partitionBy(*keys).orderBy("_run")
    tops = runs.withColumns({"_l": F.lag(y).over(rline), "_r": F.lead(y).over(rline)}).where(
        (F.col("_l") < F.col(y)) & (F.col("_r") < F.col(y)) & (F.col(y) >= height))
    ordered = tops.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col(y)).alias("k"), (-F.col(pos)).alias("p")))).alias("_all"))  # at most one per lag or bin
    empty = F.filter("_all", lambda _: F.lit(False))
    kept = F.aggregate("_all", empty, lambda acc, e: F.when(
        F.exists(acc, lambda a: F.abs(a["p"] - e["p"]) < distance), acc).otherwise(F.array_append(acc, e)))
    return ordered.select(*keys, F.explode(kept).alias("_e")).select(
        *keys, (-F.col("_e.p")).alias(pos), (-F.col("_e.k")).alias(y))


# -- direction -----------------------------------------------------------------------------------


def slopes(df: DataFrame, window: int | Share = 20, smooth: bool = True, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Least-squares line over the last w, 2w and 4w (smoothed) rows, where that many exist."""
    w = window_of(window, F.col("n"))
    k = (F.floor(w / 2).cast("int") if isinstance(window, Share) else F.lit(window // 2)) if smooth else F.lit(1)
    if isinstance(window, Share):
        step = Step(lambda s: s.add({"_y": mean_of(last_of(s, column, k, max(1, window.full // 2)))}), max(0, window.full // 2 - 1))
    else:
        step = ind.sma(window // 2 if smooth else 1, column, "_y")
    rows = tail(df, 4 * w, column, keys, order, step).where(F.col("_y").isNotNull() & wide_enough(window, F.col("n")))
    rows = rows.withColumn("back", F.col("n") - F.col("rn"))
    rows = rows.withColumn("window", F.explode(F.array(*[m * w for m in (1, 2, 4)]))).where(
        (F.col("back") < F.col("window")) & (F.col("n") - (k - 1) >= F.col("window")))
    fit = rows.groupBy(*keys, "window").agg(
        F.regr_slope("_y", "rn").alias("slope"), F.corr("_y", "rn").alias("r"), F.min_by("_y", "rn").alias("_first"), F.max("n").alias("n"))
    r = F.coalesce("r", F.lit(0.0))
    return fit.select(
        *keys, "window", "slope", (ratio(F.col("slope"), F.col("_first")) * 100).alias("normalized_slope"),
        (r * r).alias("r_squared"), F.when(F.col("slope") > 0, "uptrend").otherwise("downtrend").alias("direction"),
        F.abs(r).alias("strength"), (F.col("window") / w).cast("int").alias("windows"))


def series_summary(df: DataFrame, window: int | Share = 20, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """First and last value, overall change, volatility, distance to the extremes of the last window."""
    known = df.where(F.col(column).isNotNull())
    s = with_length(lay_out(known, 1, 0, keys, order))
    s = s.add({"_ret": ratio(F.col(column), s.lag(column)) - 1})
    recent = F.when(F.col(RN) > F.col("_len") - window_of(window, F.col("_len")), F.col(column))
    agg = s.core().groupBy(*keys).agg(
        F.max(RN).alias("n"), F.min_by(column, RN).alias("start_value"), F.max_by(column, RN).alias("current_value"),
        (F.stddev_samp("_ret") * 100).alias("volatility"), F.max(recent).alias("_hi"), F.min(recent).alias("_lo"))
    now, far = F.col("current_value"), F.col("n") > window_of(window, F.col("n"))
    return agg.where(wide_enough(window, F.col("n"))).select(
        *keys, "n", "start_value", "current_value", ((ratio(now, F.col("start_value")) - 1) * 100).alias("overall_change_pct"),
        "volatility", F.when(far, (ratio(now, F.col("_hi")) - 1) * 100).alias("percent_from_period_max"),
        F.when(far, (ratio(now, F.col("_lo")) - 1) * 100).alias("percent_from_period_min"))


def ema_order(df: DataFrame, column: str = "close", digits: int | None = None, keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Class of the last 9/21/50 exponential averages, for series longer than 50 rows."""
    spans = (9, 21, 50)
    out = compute(df.where(F.col(column).isNotNull()), [ind.ema(n, column) for n in spans], keys=keys, order=order, keep_ordinal="rn")
    last = out.groupBy(*keys).agg(F.max("rn").alias("rn"), *[F.max_by(f"ema_{n}", "rn").alias(f"ema_{n}") for n in spans]).where("rn > 50")
    if digits is not None:
        last = last.withColumns({f"ema_{n}": F.round(f"ema_{n}", digits) for n in spans})
    a, b, c = (F.col(f"ema_{n}") for n in spans)
    label = (
        F.when((a > b) & (b > c), "strong_uptrend").when((a < b) & (b < c), "strong_downtrend")
        .when((a > b) & (b < c), "potential_reversal_up").when((a < b) & (b > c), "potential_reversal_down")
        .otherwise("mixed_sideways"))
    return last.select(*keys, *[f"ema_{n}" for n in spans], label.alias("ema_trend"))


def direction_summary(df: DataFrame, window: int | Share = 20, smooth: bool = True, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """One row per series: slopes by window, current and long-term trend, ADX, EMA class, summary."""
    fits = slopes(df, window, smooth, column, keys, order)
    entry = F.struct("slope", "normalized_slope", "r_squared", "direction", "strength")
    lines = fits.groupBy(*keys).agg(  # three entries at most
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("window", entry)))).alias("slopes"),
        F.max(F.when(F.col("windows") == 1, F.col("direction"))).alias("current_trend"),
        F.max(F.when(F.col("windows") == 4, F.col("direction"))).alias("long_term_trend"))
    gate = series_summary(df, window, column, keys, order).where(F.col("n") >= 2 * window_of(window, F.col("n")))
    out = gate.join(lines, [*keys], "left").join(ema_order(df, column, None, keys, order).select(*keys, "ema_trend"), [*keys], "left")
    if {"high", "low", "close"} <= set(df.columns):
        strength = compute(df, ind.adx(14), keys=keys, order=order)
        out = out.join(strength.groupBy(*keys).agg(F.max_by("adx_14", order).alias("adx_value")), [*keys], "left")
    else:
        out = out.withColumn("adx_value", F.lit(None).cast("double"))
    return out


# -- trend changes -------------------------------------------------------------------------------


def adjacent_slopes(window: int | Share = 20, column: str = "close") -> Step:
    """Lines over the ``window`` rows before each row and the ``window`` rows from it, per mean."""
    if isinstance(window, Share):
        return _adjacent_by_share(window, column)

    def build(s: Series) -> Series:
        old, new = s.over(-window, -1), s.over(0, window - 1)
        full = (F.count(column).over(old) == window) & (F.count(column).over(new) == window)
        cols = {}
        for tag, w in (("1", old), ("2", new)):
            mean = F.avg(column).over(w)
            cols[f"slope{tag}"] = F.when(full, F.coalesce(ratio(F.regr_slope(column, RN).over(w), mean), F.lit(0.0)))
            cols[f"r{tag}"] = F.when(full, F.coalesce(F.corr(column, RN).over(w), F.lit(0.0)))
        s = s.add(cols)
        gap = F.abs(F.col("slope2") - F.col("slope1"))
        return s.add({"relative_change": gap / (F.abs("slope1") + 1e-10)})

    return Step(build, window, window - 1)


def _adjacent_by_share(window: Share, column: str) -> Step:
    def build(s: Series) -> Series:
        s = s if "_len" in s.df.columns else with_length(s)
        w = window_of(window, F.col("_len"))
        later = F.collect_list(column).over(s.over(0, window.full - 1))
        s = s.add({"_old": F.lag(last_of(s, column, w, window.full)).over(s.over()), "_new": F.when(F.size(later) >= w, F.slice(later, 1, w))})
        full = F.col("_old").isNotNull() & F.col("_new").isNotNull()
        cols = {}
        for tag, rows in (("1", F.col("_old")), ("2", F.col("_new"))):
            mean = mean_of(rows)
            slope, r = line_of(rows, mean)
            cols[f"slope{tag}"] = F.when(full, F.coalesce(ratio(slope, mean), F.lit(0.0)))
            cols[f"r{tag}"] = F.when(full, F.coalesce(r, F.lit(0.0)))
        s = s.add(cols).drop("_old", "_new")
        return s.add({"relative_change": F.abs(F.col("slope2") - F.col("slope1")) / (F.abs("slope1") + 1e-10)})

    return Step(build, window.full, window.full - 1)


def trend_changes(df: DataFrame, window: int | Share = 20, threshold: float = 0.15, column: str = "close",
                  keys: Sequence[str] = KEYS, order: str = "date", digits: int | None = None, block_rows: int | None = None) -> DataFrame:
    """Significant changes of slope; of changes within half a window the largest stays.

    Changes further apart than half a window never influence each other, so the order-dependent
    selection runs over one such run at a time, not over a series. Series of fewer than three windows
    have no changes.
    """
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    before = Step(lambda s: s.add({"before_slope": s.lag("slope2")}), 1)
    stages = [adjacent_slopes(window, column)]
    if digits is not None:
        names = ("slope1", "slope2", "r1", "r2", "relative_change")
        stages.append(Step(lambda s: s.add({c: F.round(c, digits) for c in names})))
    rows = compute(known, Step(with_length), *stages, before, keys=keys, order=order, keep_ordinal="pos", block_rows=block_rows)
    w = window_of(window, F.col("_len"))
    rows = rows.where((F.col("_len") >= 3 * w) & wide_enough(window, F.col("_len")))
    flips = F.col("slope2") * F.col("before_slope") < 0
    fits = (F.col("r1") ** 2 > 0.6) & (F.col("r2") ** 2 > 0.6)
    found = rows.where(F.col("before_slope").isNotNull() & (flips | (F.col("relative_change") > threshold)) & fits).select(
        *keys, order, "pos", F.when(flips, "reversal").otherwise("acceleration").alias("type"),
        F.col("relative_change").alias("magnitude"), "before_slope", F.col("slope2").alias("after_slope"), F.col(column).alias("value"), w.alias("_w"))
    s = lay_out(found, 1, 0, keys, order, block_rows)
    last, half = s.lag("pos"), F.col("_w") / 2
    s = s.add({"_start": F.when(last.isNull() | (F.col("pos") - last > half), F.col("pos"))})
    runs = s.running(F.max, {"_group": "_start"}, F.greatest).rows()
    item = F.struct("pos", order, "type", "magnitude", "before_slope", "after_slope", "value")
    lists = runs.groupBy(*keys, "_group").agg(F.array_sort(F.collect_list(item)).alias("_all"), F.max("_w").alias("_w"))
    none = F.filter("_all", lambda _: F.lit(False))

    def keep(acc: Column, e: Column) -> Column:
        top = F.try_element_at(acc, F.lit(-1))
        return (
            F.when((F.size(acc) == 0) | (e["pos"] - top["pos"] > half), F.array_append(acc, e))
            .when(e["magnitude"] > top["magnitude"], F.array_append(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), e))
            .otherwise(acc))

    kept = lists.select(*keys, F.explode(F.aggregate("_all", none, keep)).alias("_e")).select(*keys, "_e.*")
    b, a = F.col("before_slope"), F.col("after_slope")
    label = (
        F.when((b < 0) & (a > 0), "bullish_reversal").when((b > 0) & (a < 0), "bearish_reversal")
        .when((a > b) & (a > 0), "bullish_acceleration").when((a < b) & (a < 0), "bearish_acceleration")
        .when((a > b) & (a < 0), "bearish_deceleration").when((a < b) & (a > 0), "bullish_deceleration")
        .otherwise("unknown"))
    return kept.withColumn("trend_change", label)


# -- levels --------------------------------------------------------------------------------------


def recent_rows(df: DataFrame, window: int | Share = 20, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """The last ten windows of each series of at least two windows: bounded from here on."""
    w = window_of(window, F.col("n"))
    rows = tail(df, 10 * w, column, keys, order).where((F.col("n") >= 2 * w) & wide_enough(window, F.col("n")))
    return rows.select(*keys, order, F.col(column).alias("x"), "rn", F.least("n", 10 * w).alias("m"),
                       (F.col("rn") - F.greatest(F.col("n") - 10 * w, F.lit(0)) - 1).alias("i"), w.alias("w"))


def price_histogram(recent: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Counts over min(50, rows / 5) equal bins from minimum to maximum, empty bins included."""
    span = recent.groupBy(*keys).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.least(F.lit(50), F.floor(F.max("m") / 5)).cast("int").alias("bins"))
    span = span.withColumns({  # a flat series gets a unit range around its value
        "lo": F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi"))})
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    spot = F.least(F.floor((F.col("x") - F.col("lo")) / width).cast("int"), F.col("bins") - 1)
    counts = recent.join(span, [*keys]).groupBy(*keys, spot.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("lo") + (F.col("bin") + 0.5) * width).alias("center"), F.coalesce("count", F.lit(0)).alias("count"))


def histogram_levels(histogram: DataFrame, noise: float = 0.05, levels: int = 3, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``levels`` highest histogram peaks at least three bins apart; the higher bin on a tie."""
    top = Window.partitionBy(*keys)
    # a peak under the noise floor never displaces a taller one, so the floor can be applied last
    least = histogram.groupBy(*keys).agg((F.max("count") * noise).alias("_min"))
    peaks = find_peaks(histogram, keys, "bin", "count", 0.0, 3).join(least, [*keys]).where(F.col("count") >= F.col("_min"))
    peaks = peaks.join(histogram.select(*keys, "bin", "center"), [*keys, "bin"])
    rank = F.row_number().over(top.orderBy(F.desc("count"), F.desc("bin")))
    return peaks.withColumn("rank", rank).where(F.col("rank") <= levels).select(*keys, F.col("center").alias("level"), "rank")


def turning_points(recent: DataFrame, window: int | Share = 20, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows equal to the maximum (else the minimum) of ``window`` rows before to ``window - 1`` after."""
    line = Window.partitionBy(*keys).orderBy("rn")
    if isinstance(window, Share):
        before, after = F.collect_list("x").over(line.rowsBetween(-window.full, -1)), F.collect_list("x").over(line.rowsBetween(0, window.full - 1))
        near = F.concat(F.slice(before, F.greatest(F.size(before) - F.col("w") + 1, F.lit(1)), F.col("w")), F.slice(after, 1, F.col("w")))
        high, low = F.array_max(near), F.array_min(near)
    else:
        frame = line.rowsBetween(-window, window - 1)
        high, low = F.max("x").over(frame), F.min("x").over(frame)
    inside = (F.col("i") >= F.col("w")) & (F.col("i") < F.col("m") - F.col("w"))
    side = F.when(F.col("x") == high, "max").when(F.col("x") == low, "min")
    return recent.withColumn("side", F.when(inside, side)).where("side is not null").select(*keys, "side", "x")


def _best_split(values: np.ndarray, k: int) -> list[float]:
    """Means of the k contiguous groups of sorted values with the least squared error."""
    v = np.sort(values)
    n = len(v)
    s, q = np.concatenate([[0], np.cumsum(v)]), np.concatenate([[0], np.cumsum(v * v)])

    def cost(a, b):  # values a..b-1
        return (q[b] - q[a]) - (s[b] - s[a]) ** 2 / (b - a)

    best = np.array([0.0] + [cost(0, b) for b in range(1, n + 1)])
    cuts = []
    for _ in range(1, k):
        nxt, cut = np.full(n + 1, np.inf), np.zeros(n + 1, int)
        for b in range(len(cuts) + 2, n + 1):
            a = np.arange(len(cuts) + 1, b)
            c = best[a] + cost(a, b)
            cut[b] = a[np.argmin(c)]
            nxt[b] = c.min()
        best = nxt
        cuts.append(cut)
    edges = [n]
    for cut in reversed(cuts):
        edges.append(cut[edges[-1]])
    edges = [0, *reversed(edges)] if edges[-1] != 0 else list(reversed(edges))
    return [float(v[a:b].mean()) for a, b in zip(edges, edges[1:])]


def cluster_levels(points: DataFrame, levels: int = 3, keys: Sequence[str] = KEYS) -> DataFrame:
    """Exact one-dimensional k-means of the maxima and of the minima (at most ten windows of rows)."""
    keys = list(keys)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema if f.name in keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = {side: pdf.loc[pdf["side"] == side, "x"].to_numpy(float) for side in ("max", "min")}
        rows = []
        if all(len(v) >= levels for v in x.values()):
            rows = [(side, c) for side, v in x.items() for c in _best_split(v, levels)]
        out = pd.DataFrame(rows, columns=["side", "level"])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iat[0])
        return out

    return points.groupBy(*keys).applyInPandas(fit, f"{kinds}, side string, level double")


def support_resistance(df: DataFrame, window: int | Share = 20, noise: float = 0.05, levels: int = 3, column: str = "close",
                       keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Levels of both methods against the current price, and the nearest on each side."""
    recent = staged(recent_rows(df, window, column, keys, order))  # ten windows of rows per series, read six times
    price = recent.groupBy(*keys).agg(F.max_by("x", "rn").alias("price"))
    hist = histogram_levels(price_histogram(recent, keys), noise, levels, keys).join(price, [*keys])
    side = F.when(F.col("level") < F.col("price"), "support").when(F.col("level") > F.col("price"), "resistance")
    a = hist.select(*keys, F.lit("histogram").alias("method"), side.alias("side"), "level", (F.col("rank") == 1).alias("strongest"))
    b = cluster_levels(turning_points(recent, window, keys), levels, keys).select(
        *keys, F.lit("peaks").alias("method"), F.when(F.col("side") == "min", "support").otherwise("resistance").alias("side"), "level", F.lit(False).alias("strongest"))
    every = a.unionByName(b).join(price, [*keys])
    below = F.when((F.col("side") == "support") & (F.col("level") < F.col("price")), F.col("level"))
    above = F.when((F.col("side") == "resistance") & (F.col("level") > F.col("price")), F.col("level"))

    def pick(method: str, kind: str) -> Column:  # a handful of levels per series
        got = F.array_sort(F.collect_list(F.when((F.col("method") == method) & (F.col("side") == kind), F.col("level"))))
        return (F.reverse(got) if kind == "support" else got).alias(f"{method}_{kind}s")

    out = every.groupBy(*keys).agg(
        *[pick(m, k) for m in ("histogram", "peaks") for k in ("support", "resistance")],
        F.max(F.when(F.col("strongest"), F.col("level"))).alias("strongest_level"),
        F.max(below).alias("closest_support"), F.min(above).alias("closest_resistance"))
    out = price.join(out, [*keys], "left")
    return out.withColumns({
        "distance_to_support": (ratio(F.col("price"), F.col("closest_support")) - 1) * 100,
        "distance_to_resistance": (ratio(F.col("closest_resistance"), F.col("price")) - 1) * 100})


# -- market phase --------------------------------------------------------------------------------


def phase_inputs(df: DataFrame, window: int | Share = 90, column: str = "close", keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Peak, volatilities, recent return, long slope and RSI: one row per series of ≥ 1.5 windows."""
    known = df.where(F.col(column).isNotNull()).select(*keys, order, column)
    steps = [ind.rsi(14, column, "rsi"), Step(lambda s: s.add({"_ret": ratio(F.col(column), s.lag(column)) - 1}), 1)]
    s = lay_out(known, max(t.back for t in steps), 0, keys, order)
    for t in steps:
        s = t.build(s)
    s = with_length(s)
    gone, w = F.col("_len") - F.col(RN), window_of(window, F.col("_len"))
    year = math.sqrt(252) * 100
    agg = s.core().groupBy(*keys).agg(
        F.max(RN).alias("n"), F.max_by(column, RN).alias("price"), F.max(column).alias("ath"),
        (F.stddev_samp(F.when(gone < w - 1, F.col("_ret"))) * year).alias("recent_volatility"),
        (F.stddev_samp("_ret") * year).alias("historical_volatility"),
        F.max(F.when(gone == w - 1, F.col(column))).alias("_then"),
        F.regr_slope(column, RN).alias("_slope"), F.avg(column).alias("_mean"), F.max_by("rsi", RN).alias("rsi"))
    return agg.where((F.col("n") >= 1.5 * window_of(window, F.col("n"))) & wide_enough(window, F.col("n"))).select(
        *keys, "price", "ath", ((ratio(F.col("price"), F.col("ath")) - 1) * 100).alias("drawdown_from_ath"),
        "recent_volatility", "historical_volatility",
        F.coalesce(ratio(F.col("recent_volatility"), F.col("historical_volatility")), F.lit(1.0)).alias("volatility_ratio"),
        ((ratio(F.col("price"), F.col("_then")) - 1) * 100).alias("recent_return"),
        (ratio(F.col("_slope"), F.col("_mean")) * 100).alias("long_term_slope"), "rsi")


#: The bounds in the rules below.
def market_phase(inputs: DataFrame) -> DataFrame:
    """Phase and confidence, first match wins.

    Capitulation is tested after the bearish trend, so it is reached only when the long slope is
    not negative.
    """
    dd, ret, vol, slope, rsi = (F.col(c) for c in ("drawdown_from_ath", "recent_return", "volatility_ratio", "long_term_slope", "rsi"))
    rules = [
        ("accumulation", 0.7, (dd < -20) & (ret > 0) & (vol < 0.8) & (rsi > 40) & (rsi < 60)),
        ("bullish_trend", 0.8, (ret > 10) & (slope > 0) & (vol < 1.2) & (rsi > 50)),
        ("distribution", 0.6, (dd > -10) & (ret < 5) & (vol > 1.2) & (rsi > 70)),
        ("bearish_trend", 0.8, (ret < -10) & (slope < 0) & (vol > 1) & (rsi < 50)),
        ("capitulation", 0.7, (dd < -30) & (ret < -20) & (vol > 1.5) & (rsi < 30)),
        ("sideways", 0.6, (F.abs(ret) < 5) & (F.abs(slope) < 2) & (vol < 0.8)),
    ]
    phase = confidence = None
    for name, sure, test in rules:
        phase = F.when(test, name) if phase is None else phase.when(test, name)
        confidence = F.when(test, sure) if confidence is None else confidence.when(test, sure)
    return inputs.withColumns({"current_phase": phase.otherwise("indeterminate"), "confidence": confidence.otherwise(0.3)})
