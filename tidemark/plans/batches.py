"""The user entry points: whole batches over all symbols, each one lazy plan (or a few)."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import align as al
from tidemark.operators import cleaning as cl
from tidemark.operators import company as co
from tidemark.operators import correlation as cr
from tidemark.operators import factors as fa
from tidemark.operators import indicators as ind
from tidemark.operators import quality as qu
from tidemark.operators import seasonality as se
from tidemark.operators import signals as sig
from tidemark.operators import stationarity as st
from tidemark.operators import trend as tr
from tidemark.operators.asof import nearest_by_date
from tidemark.operators.series import KEYS, RN, Series, Step, compute
from tidemark.session import staged
from tidemark.sources import sinks

#: Default indicator periods.
STOCK_PERIODS = {"sma": [20, 50, 200], "ema": [12, 26, 50], "bb": [20], "rsi": [14], "macd": [(12, 26, 9)], "stoch": [(14, 3)], "adx": [14], "atr": [14]}
CRYPTO_SMA, CRYPTO_EMA = (7, 21, 50, 200), (7, 21, 50, 100)
TRIM = 200


def _blank_start(rows: int, keep: Sequence[str]) -> Step:
    """Make all but the ``keep`` columns unknown in the first ``rows`` rows, so that the signals after
    it see a series that starts there."""

    def build(s: Series) -> Series:
        names = [c for c in s.df.columns if not c.startswith("_") and c not in keep]
        return s.add({c: F.when(F.col(RN) > rows, F.col(c)) for c in names})

    return Step(build)


# -- stocks --------------------------------------------------------------------------------------


def stock_indicators(periods: Mapping[str, list] | None = None, include_all: bool = False) -> list[Step]:
    """The indicator set; ``periods`` replaces the defaults family by family."""
    p = {**STOCK_PERIODS, **(periods or {})}
    steps = [ind.sma(n) for n in p["sma"]] + [ind.ema(n) for n in p["ema"]]
    steps += [ind.bollinger(n, pct_b=f"bb_pct_b_{n}") for n in p["bb"]] + [ind.rsi(n) for n in p["rsi"]]
    steps += [ind.macd(*m) for m in p["macd"]] + [ind.stochastic(*s) for s in p["stoch"]]
    steps += [ind.adx(n) for n in p["adx"]] + [ind.atr(n) for n in p["atr"]]
    if include_all:
        steps += [ind.obv(), ind.cci(20), ind.williams_r(14), ind.roc(10), ind.mfi(14), ind.ichimoku()]
    return [*steps, ind.daily_return(), ind.cumulative_return()]


def stock_signals(columns: Sequence[str]) -> list[Step]:
    """The signal steps whose inputs exist."""
    table = [
        (("sma_50", "sma_200"), sig.ma_cross()), (("macd_12_26_9", "macd_signal_12_26_9"), sig.macd_cross()), (("rsi_14",), sig.rsi_signals()),
        (("bb_high_20", "bb_low_20"), sig.bollinger_signals()), (("stoch_k_14", "stoch_d_14_3"), sig.stochastic_signals()),
        (("adx_14",), sig.adx_strength()), (("sma_20",), sig.trend_label()),
    ]
    return [step for need, step in table if set(need) <= set(columns)]


def technical_indicators(df: DataFrame, periods=None, include_all=False, signals=False, trim: int | None = TRIM, keys=KEYS, order="date", block_rows=None) -> DataFrame:
    """Indicators, and signals on the trimmed series, over one shared layout."""
    cut = trim or 0
    stages = [stock_indicators(periods, include_all), [ind.volatility(20)]]
    if signals:
        p = {**STOCK_PERIODS, **(periods or {})}
        made = [f"sma_{n}" for n in p["sma"]] + [f"rsi_{n}" for n in p["rsi"]] + [f"adx_{n}" for n in p["adx"]]
        made += [f"bb_{side}_{n}" for n in p["bb"] for side in ("high", "low")]
        made += [f"{m}_{'_'.join(map(str, x))}" for x in p["macd"] for m in ("macd", "macd_signal")]
        made += [name for k, d in p["stoch"] for name in (f"stoch_k_{k}", f"stoch_d_{k}_{d}")]
        if "sma_20" not in made:
            stages[0].append(ind.sma(20))
            made.append("sma_20")
        stages += [[_blank_start(cut, df.columns)], stock_signals(made), [sig.combined_signal()]]
    out = compute(df, *stages, keys=keys, order=order, block_rows=block_rows, keep_ordinal="_n")
    return out.where(F.col("_n") > cut).drop("_n")


def stock_batch(df: DataFrame, missing="interpolate", outliers=True, indicators=True, signals=True, periods=None, include_all=False,
                trim: int | None = TRIM, tie: Sequence[str] = ("close",)) -> DataFrame:
    """Clean, then indicators, then signals, for all symbols."""
    out = staged(cl.clean_stock_data(df, missing, outliers, tie))
    return technical_indicators(out, periods, include_all, signals, trim) if indicators else out


# -- coins ---------------------------------------------------------------------------------------


def crypto_indicators(columns: Sequence[str]) -> list[list[Step]]:
    """Stages of the coin indicator set for data with these columns."""
    bars = [ind.ohlc_from_price()] if not {"open", "high", "low", "close"} <= set(columns) else []
    first = [ind.sma(n) for n in CRYPTO_SMA] + [ind.ema(n) for n in CRYPTO_EMA] + [
        ind.rsi(14), ind.macd(9, 21, 9, names=("macd_line", "macd_signal", "macd_histogram")),
        ind.bollinger(14, names=("bb_upper", "bb_middle", "bb_lower"), width="bb_width"), ind.log_return(), ind.normalized_range(7)]
    first += [ind.roc(n, out=f"roc_{n}d") for n in (1, 7, 21, 90)] + [ind.period_return(n) for n in (7, 14, 30, 90)]
    if {"market_cap", "volume"} <= set(columns):
        first.append(ind.nvt())
    if {"market_cap", "total_market_cap"} <= set(columns):
        share = F.try_divide("market_cap", "total_market_cap") * 100
        first.append(Step(lambda s: s.add({"market_dominance": share})))
    if "volume" in columns:
        first += [ind.obv(), ind.volume_ratio(14), ind.chaikin_flow(20)]
    return [bars, first, [*ind.crypto_volatility(), sig.ma_cross(), sig.cycle_trend()]]


def crypto_features(clean: DataFrame, total_market_cap: DataFrame | None = None, trim: int | None = TRIM) -> DataFrame:
    """Indicators of cleaned coins, beside the nearest total market cap if one is given. Crosses see the whole series."""
    if total_market_cap is not None:
        clean = staged(nearest_by_date(clean, total_market_cap, "total_market_cap"))
    return compute(clean, *crypto_indicators(clean.columns), keep_ordinal="_n").where(F.col("_n") > (trim or 0)).drop("_n")


def crypto_cycles(features: DataFrame) -> DataFrame:
    """Market-cycle labels; highs, extrema and quantiles see the rows given, so the trimmed ones."""
    return compute(features, [ind.drawdown(), sig.local_extrema()], [sig.phase_flags(), sig.market_cycle(), sig.bubble_flag()])


def crypto_batch(df: DataFrame, total_market_cap: DataFrame | None = None, missing="interpolate", outliers=True, cycles=True,
                 trim: int | None = TRIM, tie: Sequence[str] = ("price",)) -> DataFrame:
    """Clean, attach the nearest total market cap, indicators, market-cycle labels."""
    out = crypto_features(staged(cl.clean_crypto_data(df, missing, outliers, tie)), total_market_cap, trim)
    return crypto_cycles(staged(out)) if cycles else out


# -- companies -----------------------------------------------------------------------------------


def company_batch(income: DataFrame, balance: DataFrame, ratio_documents: DataFrame | None = None) -> dict[str, DataFrame]:
    """Cleaned statements, computed ratios and normalised ratio documents."""
    i, b = staged(co.clean_income_statement(income)), staged(co.clean_balance_sheet(balance))
    out = {"income": i, "balance": b, "ratios": co.financial_ratios(i, b)}
    if ratio_documents is not None:
        out["documents"] = co.normalize_ratios(ratio_documents)
    return out


# -- correlation ---------------------------------------------------------------------------------


#: Assets and dates that an analysis of the correlation batch needs at least, its clusters and components.
CLUSTERS, COMPONENTS, CLUSTER_ASSETS, REGIME_DATES, ROLLING_DATES, CLASS_ASSETS = 5, 3, 3, 60, 90, 2


def correlation_batch(prices: DataFrame, class_pairs: Sequence[tuple[str, str]], window: int = 30, threshold: float = 0.3, first: str | None = None,
                      last: str | None = None, method: str = "pearson") -> dict[str, DataFrame]:
    """Every analysis of the long price table ``(asset_class, asset, date, value)`` within a date range; the table is written once.

    Assets with fewer than five rows in the range are left out, and so are the analyses for which there are too few
    assets or dates; the result holds those that were done.
    """
    p = staged(al.enough_rows(al.in_range(prices, first, last)))
    size = p.agg(F.count_distinct("asset").alias("assets"), F.count_distinct("date").alias("dates")).first()
    classes = p.groupBy("asset_class").agg(F.count_distinct("asset").alias("n")).where(F.col("n") >= CLASS_ASSETS).select("asset_class")
    inside = staged(cr.METHODS[method](p.join(classes, "asset_class", "left_semi"), ["asset_class"]))
    across = staged(cr.cross_class(p, class_pairs))
    matrix = staged(cr.METHODS[method](p))
    out = {
        "intra_class": inside, "intra_class_statistics": cr.matrix_statistics(inside, ["asset_class"]),
        "cross_class_matrix": across, "cross_class": cr.matrix_statistics(across, ["block"]),
        "matrix": matrix, "statistics": cr.matrix_statistics(matrix), "by_period": cr.period_change(p, method),
    }
    if size.assets >= CLUSTER_ASSETS:
        labels = staged(fa.average_linkage(matrix, min(CLUSTERS, size.assets)))
        out |= {"clusters": labels, "within_clusters": fa.within_clusters(matrix, labels)}
        out["components"] = fa.principal_components(p, min(COMPONENTS, size.assets))
    if size.dates > REGIME_DATES:
        out["regime_changes"] = cr.regime_changes(p, window, threshold)
    if size.dates > ROLLING_DATES:
        out |= {"rolling_statistics": cr.rolling_statistics(p, window), "volatile_pairs": cr.top_pair_series(p, window)}
    return out


# -- trend ---------------------------------------------------------------------------------------


#: The largest window of each analysis and the share of a shorter series' rows it may take.
WINDOWS = {"direction": tr.Share(20, 4), "changes": tr.Share(20, 4), "levels": tr.Share(20, 5), "phase": tr.Share(90, 3), "stationarity": tr.Share(30, 4)}


def trend_batch(df: DataFrame, column: str = "close") -> dict[str, DataFrame]:
    """Direction, changes, levels, seasonality, phase and stationarity of every series, each one plan for all lengths."""
    s, w = staged(df), WINDOWS
    periods, calendar = staged(se.seasonal_periods(s, column)), staged(se.calendar_patterns(se.calendar_means(s, column)))
    return {
        "direction": tr.direction_summary(s, w["direction"], column=column),
        "changes": tr.trend_changes(s, w["changes"], column=column),
        "levels": tr.support_resistance(s, w["levels"], column=column),
        "periods": periods, "calendar": calendar, "seasonality": se.seasonality_flags(periods, calendar, s.where(F.col(column).isNotNull())),
        "phase": tr.market_phase(tr.phase_inputs(s, w["phase"], column)),
        "stationarity": st.stationarity(s, w["stationarity"], column),
    }


# -- loads ---------------------------------------------------------------------------------------


def load_batch(spark: SparkSession, root: str, loads: Mapping[str, DataFrame], process: str = "load", sequence: str = "_sequence") -> DataFrame:
    """Upsert each ``{star table: rows}`` and append to the run log: ``(table, action, records)``.

    Rows with a ``sequence`` column may repeat keys; the last one counts.
    """
    report = None
    for table, rows in loads.items():
        began = time.monotonic()
        try:
            tally = staged(sinks.upsert_star(spark, root, table, rows, sequence if sequence in rows.columns else None))
        except Exception as error:
            sinks.append_log(spark, f"{root}/etl_log", f"{process}:{table}", "failed", 0, time.monotonic() - began, str(error))
            raise
        done = tally.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
        sinks.append_log(spark, f"{root}/etl_log", f"{process}:{table}", "success", done, time.monotonic() - began)
        part = tally.withColumn("table", F.lit(table))
        report = part if report is None else report.unionByName(part)
    return report


def landing_batch(bars: DataFrame, required: Sequence[str], min_rows: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rows of the symbols that pass the gate, and all verdicts."""
    verdicts = qu.coin_gate(bars, required, min_rows)
    return bars.join(verdicts.where("valid").select("symbol"), "symbol", "left_semi"), verdicts
