"""Trading signals and market-cycle labels, as steps on indicator columns.

Every flag is 0 where one of its inputs is unknown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import flag
from tidemark.operators.series import Series, Step, exact_quantiles


def _level(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def crosses_up(s: Series, a: str, b: str | float) -> Column:
    """``a`` above ``b`` now, not above one row earlier."""
    now, before = (F.col(b), s.lag(b)) if isinstance(b, str) else (_level(b), _level(b))
    return flag((F.col(a) > now) & (s.lag(a) <= before))


def crosses_down(s: Series, a: str, b: str | float) -> Column:
    now, before = (F.col(b), s.lag(b)) if isinstance(b, str) else (_level(b), _level(b))
    return flag((F.col(a) < now) & (s.lag(a) >= before))


def ma_cross(fast: str = "sma_50", slow: str = "sma_200") -> Step:
    return Step(lambda s: s.add({
        "golden_cross": crosses_up(s, fast, slow), "death_cross": crosses_down(s, fast, slow)}), 1)


def macd_cross(line: str = "macd_12_26_9", signal: str = "macd_signal_12_26_9") -> Step:
    return Step(lambda s: s.add({
        "macd_bull_cross": crosses_up(s, line, signal), "macd_bear_cross": crosses_down(s, line, signal)}), 1)


def rsi_signals(column: str = "rsi_14", low: float = 30, high: float = 70) -> Step:
    return Step(lambda s: s.add({
        "rsi_oversold": flag(F.col(column) < low),
        "rsi_overbought": flag(F.col(column) > high),
        "rsi_bull_cross": crosses_up(s, column, low),
        "rsi_bear_cross": crosses_down(s, column, high),
    }), 1)


def bollinger_signals(high: str = "bb_high_20", low: str = "bb_low_20") -> Step:
    return Step(lambda s: s.add({
        "bb_upper_break": flag(F.col("close") > F.col(high)),
        "bb_lower_break": flag(F.col("close") < F.col(low)),
        "bb_upper_return": crosses_down(s, "close", high),
        "bb_lower_return": crosses_up(s, "close", low),
    }), 1)


def stochastic_signals(k: str = "stoch_k_14", d: str = "stoch_d_14_3", low: float = 20, high: float = 80) -> Step:
    return Step(lambda s: s.add({
        "stoch_bull_cross": crosses_up(s, k, d),
        "stoch_bear_cross": crosses_down(s, k, d),
        "stoch_oversold": flag((F.col(k) < low) & (F.col(d) < low)),
        "stoch_overbought": flag((F.col(k) > high) & (F.col(d) > high)),
    }), 1)


def adx_strength(column: str = "adx_14") -> Step:
    return Step(lambda s: s.add({
        "strong_trend": flag(F.col(column) > 25),
        "very_strong_trend": flag(F.col(column) > 50),
        "weak_trend": flag(F.col(column) < 20),
    }))


BULLISH = ("macd_bull_cross", "rsi_bull_cross", "bb_lower_return", "stoch_bull_cross")
BEARISH = ("macd_bear_cross", "rsi_bear_cross", "bb_upper_return", "stoch_bear_cross")


def combined_signal() -> Step:
    """Bullish minus bearish flags among those present."""

    def build(s: Series) -> Series:
        score = F.lit(0)
        for name in BULLISH:
            score = score + F.col(name) if name in s.df.columns else score
        for name in BEARISH:
            score = score - F.col(name) if name in s.df.columns else score
        return s.add({"combined_signal": score})

    return Step(build)


def trend_label(average: str = "sma_20") -> Step:
    def build(s: Series) -> Series:
        before = s.lag(average)
        s = s.add({
            "uptrend": flag((F.col("close") > F.col(average)) & (F.col(average) > before)),
            "downtrend": flag((F.col("close") < F.col(average)) & (F.col(average) < before)),
        })
        return s.add({"trend_label": F.col("uptrend") - F.col("downtrend")})

    return Step(build, 1)


# -- market cycle --------------------------------------------------------------------------------


def cycle_trend(fast: str = "sma_50", slow: str = "sma_200") -> Step:
    value = F.when(F.col(fast) > F.col(slow), 1).when(F.col(fast) < F.col(slow), -1).otherwise(0)
    return Step(lambda s: s.add({"trend": value}))


def local_extrema(reach: int = 10, column: str = "close") -> Step:
    """Strictly below (above) all of the ``reach`` rows on both sides. Uses future rows."""

    def build(s: Series) -> Series:
        left, right = s.over(-reach, -1), s.over(1, reach)
        x = F.col(column)
        inside = (F.count(column).over(left) == reach) & (F.count(column).over(right) == reach)
        return s.add({
            "local_bottom": flag(inside & (x < F.min(column).over(left)) & (x < F.min(column).over(right))),
            "local_top": flag(inside & (x > F.max(column).over(left)) & (x > F.max(column).over(right))),
        })

    return Step(build, reach, reach)


def phase_flags(lag: int = 7) -> Step:
    """Accumulation, bullish, distribution and bearish phases."""

    def build(s: Series) -> Series:
        rsi, trend, down, hist = (F.col(c) for c in ("rsi_14", "trend", "drawdown_from_ath", "macd_histogram"))
        rsi_then, hist_then = s.lag("rsi_14", lag), s.lag("macd_histogram", lag)
        return s.add({
            "accumulation_phase": flag((trend == -1) & (rsi > 50) & (rsi_then < 45) & (down < -20)),
            "bullish_phase": flag((trend == 1) & (rsi > 55) & (hist > 0)),
            "distribution_phase": flag((down > -10) & (rsi < 70) & (rsi_then > 75) & (hist < hist_then)),
            "bearish_phase": flag((trend == -1) & (rsi < 45) & (hist < 0)),
        })

    return Step(build, lag)


def bubble_flag(vol: str = "volatility_30d", ret: str = "return_90d") -> Step:
    """High volatility and extreme return against the quantiles of the whole series (look-ahead)."""

    def build(s: Series) -> Series:
        s = s.staged()
        both = exact_quantiles(s.core(), [vol, ret], (0.85, 0.90), s.keys, s.order)
        s = s.join_per_series(both.select(*s.keys, f"{vol}_q0", f"{ret}_q1"))
        value = flag((F.col(vol) > F.col(f"{vol}_q0")) & (F.col(ret) > F.col(f"{ret}_q1")))
        return s.add({"bubble_indicator": value}).drop(f"{vol}_q0", f"{ret}_q1")

    return Step(build)


#: The label of each market cycle number.
CYCLE_LABELS = {
    1: "Fondo de Mercado",
    2: "Recuperación",
    3: "Fase Alcista",
    4: "Euforia (Cerca de ATH)",
    5: "Fase Bajista",
}


def market_cycle() -> Step:
    """Cycle 1–5 by drawdown and trend, first match wins; 0 without a label otherwise."""
    down, trend = F.col("drawdown_from_ath"), F.col("trend")
    number = (
        F.when((down < -60) & (trend == -1), 1)
        .when((down < -20) & (trend == 1), 2)
        .when((down > -20) & (trend == 1), 3)
        .when(down > -10, 4)
        .when((down < -10) & (trend == -1), 5)
        .otherwise(0)
    )
    label = F.lit(None).cast("string")
    for value, text in CYCLE_LABELS.items():
        label = F.when(F.col("market_cycle") == value, text).otherwise(label)
    return Step(lambda s: s.add({"market_cycle": number}).add({"market_cycle_label": label}))
