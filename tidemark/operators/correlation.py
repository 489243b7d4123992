"""Correlation of many assets: matrices, periods, rolling windows and regime changes.

Prices stay long: ``(asset, date, value)``, one row per asset and date. Pairs are never joined row
by row. Assets are hashed into tiles; a task gets the rows of two tiles over one stretch of dates
and multiplies them as matrices, so a row travels once per tile, not once per partner, and what
leaves a task is one partial sum per pair. Tiles and stretches bound every group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators.ranking import average_ranks
from tidemark.operators.series import BLK, RN, Step, compute, lay_out
from tidemark.session import staged

PAIR = ("symbol_1", "symbol_2")
TILE_ASSETS = 128  # assets per tile when multiplying
ROLLING_TILE_ASSETS = 32  # smaller: a rolling task holds one value per pair and date
KENDALL_TILE_ASSETS = 32  # a task works on every pair of its two tiles over all dates
PAIRS_AT_ONCE = 1 << 20  # values of a task's pairs that are sorted together
DAYS_PER_STRETCH = 2048
DATES_PER_BLOCK = 256


# -- rows ----------------------------------------------------------------------------------------


def complete_rows(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Rows of the dates on which every asset (of the group) has a value."""
    known = df.where(F.col("value").isNotNull())
    per_date = known.groupBy(*groups, "date").agg(F.count(F.lit(1)).alias("_present"))
    universe = known.select(*groups, "asset").distinct().groupBy(*groups).agg(F.count(F.lit(1)).alias("_assets"))
    if groups:
        full = per_date.join(universe, [*groups])
    else:
        full = per_date.withColumn("_assets", universe.scalar())
    full = full.where("_present = _assets").select(*groups, "date")
    return known.join(full, [*groups, "date"], "left_semi")


def _tiled(df: DataFrame, per_tile: int) -> DataFrame:
    """Send each row to the tile pairs its asset takes part in, as ``_lo <= _hi``."""
    count = df.select("asset").distinct().agg(F.ceil(F.count(F.lit(1)) / per_tile).cast("int").alias("n"))
    tiles = df.withColumn("_tiles", F.greatest(count.scalar(), F.lit(1)))
    tiles = tiles.withColumn("_tile", F.pmod(F.xxhash64("asset"), F.col("_tiles")).cast("int"))
    fanned = tiles.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    return fanned.withColumns({
        "_lo": F.least("_tile", "_other"), "_hi": F.greatest("_tile", "_other")
    }).drop("_tiles", "_other")


def _centred(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Subtract each asset's mean, which correlation ignores and rounding does not."""
    means = df.groupBy(*groups, "asset").agg(F.avg("value").alias("_mean"))
    return df.join(means, [*groups, "asset"]).withColumn("value", F.col("value") - F.col("_mean")).drop("_mean")


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Dates × assets, and the index pairs (i, j), name i < name j, that belong to this tile pair."""
    wide = pdf.pivot(index="date", columns="asset", values="value").sort_index()
    tile = pdf.drop_duplicates("asset").set_index("asset")["_tile"].reindex(wide.columns).to_numpy()
    i, j = np.triu_indices(len(wide.columns), 1)
    if pdf["_lo"].iat[0] != pdf["_hi"].iat[0]:
        across = tile[i] != tile[j]
        i, j = i[across], j[across]
    return wide, i, j


def _nothing(*columns: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})


# -- matrices ------------------------------------------------------------------------------------


def _pair_sums(groups: Sequence[str]):
    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        wide, i, j = _sides(pdf)
        x = wide.to_numpy(dtype=float)
        m = ~np.isnan(x)
        x, m = np.where(m, x, 0.0), m.astype(float)
        n, sx, sxx, sxy = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
        names = wide.columns.to_numpy()
        out = {g: [pdf[g].iat[0]] * len(i) for g in groups}
        out |= {
            "symbol_1": names[i], "symbol_2": names[j], "n": n[i, j].astype("int64"),
            "sx": sx[i, j], "sy": sx[j, i], "sxx": sxx[i, j], "syy": sxx[j, i], "sxy": sxy[i, j],
        }
        return pd.DataFrame(out)

    return sums


def _corr_from_sums() -> Column:
    n = F.col("n")
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    tiny = F.lit(1e-12) * n
    usable = (vx > tiny * F.col("sxx")) & (vy > tiny * F.col("syy"))
    return F.when(usable, ratio(cov, F.sqrt(vx) * F.sqrt(vy)))


def pairwise(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair over the rows both have: ``(…, symbol_1, symbol_2, corr, n)``."""
    groups = list(groups)
    rows = _tiled(_centred(df.where(F.col("value").isNotNull()), groups), TILE_ASSETS)
    rows = rows.withColumn("_stretch", F.floor(F.unix_date("date") / DAYS_PER_STRETCH).cast("int"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([f"{g} {kinds[g]}" for g in groups] + [
        "symbol_1 string", "symbol_2 string", "n long", "sx double", "sy double", "sxx double", "syy double", "sxy double"])
    parts = rows.groupBy(*groups, "_lo", "_hi", "_stretch").applyInPandas(_pair_sums(groups), schema)
    total = parts.groupBy(*groups, *PAIR).agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    return total.where("n > 0").select(*groups, *PAIR, _corr_from_sums().alias("corr"), "n")


def pearson(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Matrix over complete rows only."""
    return pairwise(complete_rows(df, groups), groups)


def spearman(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Pearson of average ranks. Over complete rows all assets have equally many dates."""
    rows = average_ranks(staged(complete_rows(df, groups)), [*groups, "asset"], "value", "date")
    return pairwise(rows.withColumn("value", F.col("rank")).drop("rank"), groups)


def discordant(y: np.ndarray) -> np.ndarray:
    """Per column the number of pairs of rows whose later value is smaller, by merging sorted halves: n log n, all columns at once."""
    n, p = y.shape
    size = 1 << max(0, n - 1).bit_length()
    y = np.concatenate([y, np.full((size - n, p), np.iinfo(y.dtype).max, y.dtype)])  # last and largest: in no such pair
    out, width = np.zeros(p, np.int64), 1
    while width < size:
        y = y.reshape(size // (2 * width), 2 * width, p)
        order = np.argsort(y, axis=1, kind="stable")  # equal values: the left half first
        place = np.arange(2 * width).reshape(1, -1, 1)
        right = order >= width
        # the value at merged place m that is r-th in its half has m - r of the left half before it
        out += np.where(right, width - (place - (order - width)), 0).sum(axis=(0, 1))
        y = np.take_along_axis(y, order, axis=1)
        width *= 2
    return out


def _ties(sorted_columns: np.ndarray) -> np.ndarray:
    """Per column the number of pairs of equal values, from columns in order."""
    n, p = sorted_columns.shape
    new = np.ones((n, p), bool)
    new[1:] = sorted_columns[1:] != sorted_columns[:-1]
    out = np.empty(p)
    for c in range(p):
        sizes = np.diff(np.append(np.flatnonzero(new[:, c]), n))
        out[c] = (sizes * (sizes - 1) // 2).sum()
    return out


def _tau(pdf: pd.DataFrame, groups: Sequence[str] = ()) -> pd.DataFrame:
    """Tau-b of the pairs of a tile pair, from all their complete dates."""
    wide, i, j = _sides(pdf)
    names, n = wide.columns.to_numpy(), len(wide)
    x = wide.to_numpy(dtype=float)
    rank = np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], axis=1).astype(np.int64)
    pairs = n * (n - 1) / 2
    tied = _ties(np.sort(rank, axis=0))
    corr = np.full(len(i), np.nan)
    for a in np.unique(i):
        mine = np.flatnonzero(i == a)
        for some in np.array_split(mine, max(1, -(-len(mine) * n // PAIRS_AT_ONCE))):
            both = rank[:, [a]] * n + rank[:, j[some]]
            order = np.argsort(both, axis=0, kind="stable")  # by the first asset, equal ones by the second
            swaps = discordant(np.take_along_axis(rank[:, j[some]], order, axis=0))
            joint = _ties(np.take_along_axis(both, order, axis=0))
            score = pairs - tied[a] - tied[j[some]] + joint - 2 * swaps
            with np.errstate(divide="ignore", invalid="ignore"):
                corr[some] = score / np.sqrt(pairs - tied[a]) / np.sqrt(pairs - tied[j[some]])
    return pd.DataFrame({g: [pdf[g].iat[0]] * len(i) for g in groups} | {"symbol_1": names[i], "symbol_2": names[j], "corr": corr, "n": n})


def kendall(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Tau-b over complete rows, n log n per pair: order by one asset, count the swaps in the other by merging.

    A task takes two tiles of assets, so a row travels once per tile. Its dates are days, which the calendar bounds.
    """
    groups = list(groups)
    tiled = _tiled(staged(complete_rows(df, groups)), KENDALL_TILE_ASSETS)
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.schema if f.name in groups) + "symbol_1 string, symbol_2 string, corr double, n long"
    out = tiled.groupBy(*groups, "_lo", "_hi").applyInPandas(lambda pdf: _tau(pdf, groups), schema)
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


METHODS = {"pearson": pearson, "spearman": spearman, "kendall": kendall}


def matrix_statistics(matrix: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Mean, extremes and the most and least correlated pair of a long matrix."""
    pair = F.struct(*PAIR)
    return matrix.groupBy(*groups).agg(
        F.avg("corr").alias("avg_correlation"), F.min("corr").alias("min_correlation"),
        F.max("corr").alias("max_correlation"),
        F.min_by(pair, F.struct("corr", *PAIR)).alias("_least"), F.max_by(pair, F.struct("corr", *PAIR)).alias("_most"),
    ).select(
        *groups, "avg_correlation", "min_correlation", "max_correlation",
        F.col("_least.symbol_1").alias("least_1"), F.col("_least.symbol_2").alias("least_2"),
        F.col("_most.symbol_1").alias("most_1"), F.col("_most.symbol_2").alias("most_2"),
    )


def by_period(df: DataFrame, periods: Sequence[tuple[str, Column, Column]], min_rows: int = 5, method: str = "pearson") -> DataFrame:
    """Correlation per named period, bounds inclusive: Pearson over the rows each pair shares, ranked methods over the period's complete rows.

    ``periods`` holds (name, first day, last day); a period with fewer dates than ``min_rows`` is left out.
    """
    names = [F.when(F.col("date").between(a, z), F.lit(n)) for n, a, z in periods]
    rows = df.withColumn("period", F.explode(F.array_compact(F.array(*names))))
    enough = rows.select("period", "date").distinct().groupBy("period").agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") >= min_rows)
    rows = rows.join(enough, "period", "left_semi")
    return pairwise(rows, ["period"]) if method == "pearson" else METHODS[method](rows, ["period"])


def halves(df: DataFrame) -> list[tuple[str, Column, Column]]:
    """First and second half of the data's date range; the middle day belongs to both."""
    day = lambda e: df.agg(e.alias("d")).scalar()
    first, last = day(F.min("date")), day(F.max("date"))
    middle = F.date_add(first, F.floor(F.datediff(last, first) / 2).cast("int"))
    return [("first_half", first, middle), ("second_half", middle, last)]


def period_change(df: DataFrame, method: str = "pearson") -> DataFrame:
    """Correlation of each pair in both halves and its change."""
    both = by_period(df, halves(df), method=method).groupBy(*PAIR).pivot("period", ["first_half", "second_half"]).agg(F.first("corr"))
    return both.withColumn("change", F.col("second_half") - F.col("first_half"))


def cross_class(df: DataFrame, class_pairs: Sequence[tuple[str, str]], min_rows: int = 10) -> DataFrame:
    """Correlation between two asset classes over the dates complete in both.

    A class pair needs more than ``min_rows`` dates on which both classes have rows, complete or not.
    """
    blocks = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in class_pairs])
    mine = F.filter(blocks, lambda p: (p["a"] == F.col("asset_class")) | (p["b"] == F.col("asset_class")))
    rows = df.withColumn("_b", F.explode(mine)).withColumn("block", F.concat_ws("_", "_b.a", "_b.b")).drop("_b")
    matrix = pearson(rows, ["block"])
    shared = rows.where(F.col("value").isNotNull()).groupBy("block", "date").agg(F.count_distinct("asset_class").alias("k")).where("k = 2")
    enough = shared.groupBy("block").agg(F.count(F.lit(1)).alias("dates")).where(F.col("dates") > min_rows)
    matrix = matrix.join(enough.select("block"), "block", "left_semi")
    classes = df.select("asset", "asset_class").distinct()
    one = classes.select(F.col("asset").alias("symbol_1"), F.col("asset_class").alias("class_1"))
    two = classes.select(F.col("asset").alias("symbol_2"), F.col("asset_class").alias("class_2"))
    return matrix.join(one, "symbol_1").join(two, "symbol_2").where(
        F.col("class_1") != F.col("class_2"))


# -- rolling windows -----------------------------------------------------------------------------


def _rolling_matrix(x: np.ndarray, i: np.ndarray, j: np.ndarray, window: int, chunk: int = 512):
    """Correlation of each pair over every full window, ``(windows, pairs)`` in chunks of pairs."""
    known = ~np.isnan(x)
    v, m = np.where(known, x, 0.0), known.astype(float)

    def rolled(a: np.ndarray) -> np.ndarray:
        c = np.vstack([np.zeros((1, a.shape[1])), np.cumsum(a, axis=0)])
        return c[window:] - c[:-window]

    for at in range(0, len(i), chunk):
        p, q = i[at: at + chunk], j[at: at + chunk]
        vp, vq, mp, mq = v[:, p], v[:, q], m[:, p], m[:, q]
        n, sx, sy = rolled(mp * mq), rolled(vp * mq), rolled(vq * mp)
        sxx, syy, sxy = rolled(vp * vp * mq), rolled(vq * vq * mp), rolled(vp * vq)
        vx, vy = n * sxx - sx * sx, n * syy - sy * sy
        with np.errstate(divide="ignore", invalid="ignore"):
            r = (n * sxy - sx * sy) / (np.sqrt(vx) * np.sqrt(vy))
        r[~((vx > 1e-12 * n * sxx) & (vy > 1e-12 * n * syy))] = np.nan
        yield at, np.clip(r, -1.0, 1.0)


def _in_blocks(df: DataFrame, before: int, after: int) -> tuple[DataFrame, int]:
    """Rows with the block of dates they serve; dates are numbered once, in a table of one row each."""
    df = _centred(df, [])
    dates = df.select("date").distinct().withColumn("_all", F.lit(1))
    block = max(DATES_PER_BLOCK, 2 * (before + after))
    laid = lay_out(dates, before, after, keys=("_all",), block_rows=block)
    return _tiled(df.join(laid.df.drop("_all"), "date"), ROLLING_TILE_ASSETS), block


def _row_numbers(pdf: pd.DataFrame, index: pd.Index) -> np.ndarray:
    return pdf.drop_duplicates("date").set_index("date")[RN].reindex(index).to_numpy()


def rolling(df: DataFrame, window: int, method: str = "pearson") -> DataFrame:
    """Correlation of each pair over the last ``window`` complete rows: ``(symbol_1, symbol_2, date, corr)``."""
    rows = complete_rows(df)
    if method != "pearson":
        return _rolling_ranked(rows, window, method)
    placed, block = _in_blocks(rows, window - 1, 0)

    def windows(pdf: pd.DataFrame) -> pd.DataFrame:
        wide, i, j = _sides(pdf)
        names, rn = wide.columns.to_numpy(), _row_numbers(pdf, wide.index)
        ends = np.arange(window - 1, len(wide))
        mine = (rn[ends] - 1) // block == pdf[BLK].iat[0] if len(ends) else np.zeros(0, bool)
        days = wide.index.to_numpy()[ends][mine]
        frames = [_nothing("symbol_1", "symbol_2", "date", "corr")]
        if len(days):
            for at, r in _rolling_matrix(wide.to_numpy(dtype=float), i, j, window):
                p, q = i[at: at + r.shape[1]], j[at: at + r.shape[1]]
                frames.append(pd.DataFrame({
                    "symbol_1": np.repeat(names[p], len(days)), "symbol_2": np.repeat(names[q], len(days)),
                    "date": np.tile(days, len(p)), "corr": r[mine].T.ravel(),
                }))
        return pd.concat(frames[1:] or frames)

    out = placed.groupBy("_lo", "_hi", BLK).applyInPandas(windows, "symbol_1 string, symbol_2 string, date date, corr double")
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


def _rolling_ranked(rows: DataFrame, window: int, method: str) -> DataFrame:
    """Spearman or Kendall per window: the windows of a tile pair are ranked or signed in the task."""
    placed, block = _in_blocks(rows, window - 1, 0)

    def windows(pdf: pd.DataFrame) -> pd.DataFrame:
        wide, i, j = _sides(pdf)
        names, rn, x = wide.columns.to_numpy(), _row_numbers(pdf, wide.index), wide.to_numpy(dtype=float)
        frames = [_nothing("symbol_1", "symbol_2", "date", "corr")]
        for end in range(window - 1, len(x)):
            if (rn[end] - 1) // block != pdf[BLK].iat[0]:
                continue
            part = x[end - window + 1: end + 1]
            if method == "spearman":
                f = pd.DataFrame(part).rank().to_numpy()
                f = f - f.mean(axis=0)
            else:
                t, u = np.triu_indices(window, 1)
                f = np.sign(part[t] - part[u])
            norm = np.sqrt((f * f).sum(axis=0))
            with np.errstate(divide="ignore", invalid="ignore"):
                r = (f.T @ f) / np.outer(norm, norm)
            frames.append(pd.DataFrame({
                "symbol_1": names[i], "symbol_2": names[j], "date": wide.index[end], "corr": r[i, j]}))
        return pd.concat(frames[1:] or frames)

    out = placed.groupBy("_lo", "_hi", BLK).applyInPandas(windows, "symbol_1 string, symbol_2 string, date date, corr double")
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


def rolling_statistics(df: DataFrame, window: int) -> DataFrame:
    """Mean, population deviation and range of each pair's rolling correlation.

    Only a pair's sums leave the task, not its series.
    """
    placed, block = _in_blocks(complete_rows(df), window - 1, 0)

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        wide, i, j = _sides(pdf)
        names, rn = wide.columns.to_numpy(), _row_numbers(pdf, wide.index)
        ends = np.arange(window - 1, len(wide))
        mine = (rn[ends] - 1) // block == pdf[BLK].iat[0] if len(ends) else np.zeros(0, bool)
        frames = [_nothing("symbol_1", "symbol_2", "n", "s", "ss", "lo", "hi")]
        if mine.any():
            for at, r in _rolling_matrix(wide.to_numpy(dtype=float), i, j, window):
                p, q, r = i[at: at + r.shape[1]], j[at: at + r.shape[1]], r[mine]
                seen = ~np.isnan(r)
                z = np.where(seen, r, 0.0)
                frames.append(pd.DataFrame({
                    "symbol_1": names[p], "symbol_2": names[q], "n": seen.sum(axis=0), "s": z.sum(axis=0),
                    "ss": (z * z).sum(axis=0), "lo": np.where(seen, r, np.inf).min(axis=0),
                    "hi": np.where(seen, r, -np.inf).max(axis=0),
                }))
        return pd.concat(frames[1:] or frames)

    parts = placed.groupBy("_lo", "_hi", BLK).applyInPandas(
        sums, "symbol_1 string, symbol_2 string, n long, s double, ss double, lo double, hi double")
    total = parts.groupBy(*PAIR).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    mean = F.col("s") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0)))
    return total.where("n > 0").select(
        *PAIR, mean.alias("avg_correlation"), spread.alias("correlation_volatility"),
        (F.col("hi") - F.col("lo")).alias("correlation_change"))


def top_volatile_pairs(df: DataFrame, window: int = 30, top: int = 5) -> DataFrame:
    """The ``top`` pairs by volatility of their rolling correlation."""
    return rolling_statistics(df, window).orderBy(F.desc("correlation_volatility"), *PAIR).limit(top)


def top_pair_series(df: DataFrame, window: int = 30, top: int = 5) -> DataFrame:
    """Rolling correlation of those pairs over the rows each pair shares."""
    pairs = top_volatile_pairs(df, window, top).select(*PAIR)
    known = df.where(F.col("value").isNotNull())
    one = known.select(F.col("asset").alias("symbol_1"), "date", F.col("value").alias("_x"))
    two = known.select(F.col("asset").alias("symbol_2"), "date", F.col("value").alias("_y"))
    shared = staged(pairs.join(one, "symbol_1").join(two, ["symbol_2", "date"]))
    step = Step(lambda s: s.add({"corr": F.when(F.col(RN) >= window, F.corr("_x", "_y").over(s.last_rows(window)))}), window - 1)
    out = compute(shared, step, keys=PAIR, keep_ordinal="_n")
    return out.where(F.col("_n") >= window).select(*PAIR, "date", "corr")


# -- regime changes ------------------------------------------------------------------------------


def adjacent_difference(df: DataFrame, window: int = 30, threshold: float = 0.3, top: int = 5) -> DataFrame:
    """Per date, the mean |correlation after − before| over all pairs, and the ``top`` changed pairs.

    Before: the ``window`` rows up to the previous one; after: the ``window`` rows from this one.
    A date where some pair has no correlation gives NULL. All pairs of the whole input count, also those
    of assets without a row near the date, so block and tile sizes do not matter.
    """
    known = df.where(F.col("value").isNotNull())
    assets = known.select("asset").distinct().agg((F.count(F.lit(1)) * (F.count(F.lit(1)) - 1) / 2).cast("long").alias("all_pairs"))
    placed, block = _in_blocks(known, window, window - 1)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        wide, i, j = _sides(pdf)
        names, rn = wide.columns.to_numpy(), _row_numbers(pdf, wide.index)
        at_row = np.arange(window, len(wide) - window + 1)
        mine = at_row[(rn[at_row] - 1) // block == pdf[BLK].iat[0]] if len(at_row) else at_row
        cols = ("date", "total", "pairs", "missing", "changed")
        if not len(mine) or not len(i):
            return _nothing(*cols)
        total, missing = np.zeros(len(mine)), np.zeros(len(mine), int)
        best: list[list[tuple]] = [[] for _ in mine]
        for start, r in _rolling_matrix(wide.to_numpy(dtype=float), i, j, window):
            before, after = r[mine - window], r[mine]
            gap = np.abs(after - before)
            missing += np.isnan(gap).sum(axis=1)
            total += np.nansum(gap, axis=1)
            for row, col in zip(*np.nonzero(gap > threshold)):
                p = start + col
                best[row].append((gap[row, col], names[i[p]], names[j[p]], before[row, col], after[row, col]))
            best = [sorted(b, key=lambda t: (-t[0], t[1], t[2]))[:top] for b in best]
        changed = [[dict(change=c, symbol_1=a, symbol_2=b, before=x, after=y) for c, a, b, x, y in rows] for rows in best]
        return pd.DataFrame({
            "date": wide.index.to_numpy()[mine], "total": total, "pairs": len(i), "missing": missing, "changed": changed})

    pair = "struct<change:double,symbol_1:string,symbol_2:string,before:double,after:double>"
    parts = placed.groupBy("_lo", "_hi", BLK).applyInPandas(
        compare, f"date date, total double, pairs long, missing long, changed array<{pair}>")
    daily = parts.groupBy("date").agg(
        F.sum("total").alias("total"), F.sum("pairs").alias("pairs"), F.sum("missing").alias("missing"),
        F.flatten(F.collect_list("changed")).alias("changed"))  # top few per tile pair
    ranked = F.expr(
        "array_sort(changed, (l, r) -> case when l.change > r.change then -1 when l.change < r.change then 1"
        " when l.symbol_1 < r.symbol_1 then -1 when l.symbol_1 > r.symbol_1 then 1"
        " when l.symbol_2 < r.symbol_2 then -1 when l.symbol_2 > r.symbol_2 then 1 else 0 end)")
    complete = (F.col("missing") == 0) & (F.col("pairs") == assets.scalar())
    return daily.select(
        "date", F.when(complete, F.col("total") / F.col("pairs")).alias("difference"),
        F.slice(ranked, 1, top).alias("changed"))


def regime_changes(df: DataFrame, window: int = 30, threshold: float = 0.3, top: int = 5, digits: int | None = None) -> DataFrame:
    """Dates whose difference exceeds the threshold, at least ``window``/2 days after the last kept one."""
    found = adjacent_difference(df, window, threshold, top)
    if digits is not None:
        found = found.withColumn("difference", F.round("difference", digits))
    found = staged(found.where(F.col("difference") > threshold))
    # candidates are at most one per calendar day, so the ordered fold works on a bounded list
    kept = found.agg(F.array_sort(F.collect_list("date")).alias("days")).select(F.explode(F.aggregate(
        "days", F.array().cast("array<date>"),
        lambda acc, d: F.when(
            (F.size(acc) == 0) | (F.datediff(d, F.try_element_at(acc, F.lit(-1))) > window / 2), F.array_append(acc, d)
        ).otherwise(acc))).alias("date"))
    return found.join(kept, "date", "left_semi")
