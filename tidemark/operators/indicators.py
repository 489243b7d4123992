"""Technical indicators as steps on a laid-out series. NULL until enough rows exist."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators.series import RN, Series, Step, memory


def from_row(n: int, value: Column) -> Column:
    return F.when(F.col(RN) >= n, value)


# -- averages and bands --------------------------------------------------------------------------


def sma(n: int, column: str = "close", out: str | None = None) -> Step:
    name = out or f"sma_{n}"
    return Step(lambda s: s.add({name: s.warm(n, F.avg(column).over(s.last_rows(n)), column)}), n - 1)


def _ema_decay(n: int) -> float:
    return 1 - 2 / (n + 1)


def _ema(column: str, n: int, start: int = 1) -> tuple[Column, float]:
    """Scan step of an average seeded with the value at row ``start``."""
    x = F.col(column)
    step = F.when(F.col(RN) == start, x).when(F.col(RN) > start, x * (2 / (n + 1))).otherwise(F.lit(0.0))
    return step, _ema_decay(n)


def ema(n: int, column: str = "close", out: str | None = None) -> Step:
    name = out or f"ema_{n}"

    def build(s: Series) -> Series:
        s = s.exponential({name: _ema(column, n)})
        return s.add({name: from_row(n, F.col(name))})

    return Step(build, memory(_ema_decay(n)))


def bollinger(n: int = 20, k: float = 2.0, column: str = "close", names: tuple[str, str, str] | None = None,
              pct_b: str | None = None, width: str | None = None) -> Step:
    """Mean ± k population deviations; optionally %B and the relative width."""
    high, mid, low = names or (f"bb_high_{n}", f"bb_mid_{n}", f"bb_low_{n}")

    def build(s: Series) -> Series:
        w = s.last_rows(n)
        s = s.add({mid: s.warm(n, F.avg(column).over(w), column), "_dev": F.stddev_pop(column).over(w)})
        s = s.add({high: F.col(mid) + F.col("_dev") * k, low: F.col(mid) - F.col("_dev") * k})
        if pct_b:
            s = s.add({pct_b: ratio(F.col(column) - F.col(low), F.col(high) - F.col(low))})
        if width:
            s = s.add({width: ratio(F.col(high) - F.col(low), F.col(mid))})
        return s.drop("_dev")

    return Step(build, n - 1)


# -- momentum ------------------------------------------------------------------------------------


def _wilder(columns: dict[str, str], n: int, seed_row: int | None = None):
    """Wilder averages ``{output: input}``: from row 1 with its own value, or from ``seed_row`` with
    the mean of the first n values."""
    row = F.col(RN)

    def build(s: Series) -> Series:
        if seed_row is None:
            steps = {out: (F.when(row == 1, F.col(c)).otherwise(F.col(c) / n), 1 - 1 / n) for out, c in columns.items()}
            return s.exponential(steps)
        s = s.add({f"_seed_{out}": F.avg(c).over(s.last_rows(n)) for out, c in columns.items()})
        s = s.exponential({
            out: (F.when(row < seed_row, F.lit(0.0)).when(row == seed_row, F.col(f"_seed_{out}")).otherwise(F.col(c) / n), 1 - 1 / n)
            for out, c in columns.items()})
        s = s.add({out: from_row(seed_row, F.col(out)) for out in columns})
        return s.drop(*[f"_seed_{out}" for out in columns])

    return build


def rsi(n: int = 14, column: str = "close", out: str | None = None) -> Step:
    name = out or f"rsi_{n}"

    def build(s: Series) -> Series:
        change = F.coalesce(F.col(column) - s.lag(column), F.lit(0.0))
        s = s.add({"_change": change})
        s = s.add({"_up": F.greatest("_change", F.lit(0.0)), "_down": F.greatest(-F.col("_change"), F.lit(0.0))})
        s = _wilder({"_gain": "_up", "_loss": "_down"}, n)(s)
        value = F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(
            100 - F.lit(100.0) / (1 + ratio(F.col("_gain"), F.col("_loss")))
        )
        return s.add({name: from_row(n, value)}).drop("_change", "_up", "_down", "_gain", "_loss")

    return Step(build, memory(1 - 1 / n) + 1)


def macd(fast: int = 12, slow: int = 26, signal: int = 9, column: str = "close",
         names: tuple[str, str, str] | None = None) -> Step:
    """Line, signal and histogram. EMA columns computed earlier in the same run are reused."""
    tag = f"{fast}_{slow}_{signal}"
    line, sig, hist = names or (f"macd_{tag}", f"macd_signal_{tag}", f"macd_hist_{tag}")

    def build(s: Series) -> Series:
        names = {}
        for n in (fast, slow):
            reusable = column == "close" and f"ema_{n}" in s.df.columns
            names[n] = f"ema_{n}" if reusable else f"_ema_{n}"
        made = [n for n in (fast, slow) if names[n].startswith("_")]
        s = s.exponential({names[n]: _ema(column, n) for n in made})
        s = s.add({line: from_row(slow, F.col(names[fast]) - F.col(names[slow]))}).drop(*[names[n] for n in made])
        s = s.exponential({sig: _ema(line, signal, start=slow)})
        s = s.add({sig: from_row(slow + signal - 1, F.col(sig))})
        return s.add({hist: F.col(line) - F.col(sig)})

    return Step(build, memory(_ema_decay(slow)) + memory(_ema_decay(signal)))


def stochastic(k: int = 14, d: int = 3) -> Step:
    kn, dn = f"stoch_k_{k}", f"stoch_d_{k}_{d}"

    def build(s: Series) -> Series:
        w = s.last_rows(k)
        s = s.add({"_ll": F.min("low").over(w), "_hh": F.max("high").over(w)})
        value = ratio(F.col("close") - F.col("_ll"), F.col("_hh") - F.col("_ll")) * 100
        s = s.add({kn: from_row(k, value)}).drop("_ll", "_hh")
        return s.add({dn: s.warm(d, F.avg(kn).over(s.last_rows(d)), kn)})

    return Step(build, k + d - 2)


def williams_r(n: int = 14) -> Step:
    def build(s: Series) -> Series:
        w = s.last_rows(n)
        s = s.add({"_ll": F.min("low").over(w), "_hh": F.max("high").over(w)})
        value = ratio(F.col("_hh") - F.col("close"), F.col("_hh") - F.col("_ll")) * -100
        return s.add({f"williams_r_{n}": from_row(n, value)}).drop("_ll", "_hh")

    return Step(build, n - 1)


def roc(n: int, column: str = "close", out: str | None = None) -> Step:
    return Step(lambda s: s.add({out or f"roc_{n}": (ratio(F.col(column), s.lag(column, n)) - 1) * 100}), n)


def cci(n: int = 20) -> Step:
    """Typical price against its mean, in units of 0.015 mean absolute deviations."""

    def build(s: Series) -> Series:
        s = s.add({"_tp": (F.col("high") + F.col("low") + F.col("close")) / 3})
        w = s.last_rows(n)
        s = s.add({"_mean": s.warm(n, F.avg("_tp").over(w), "_tp"), "_seen": F.collect_list("_tp").over(w)})
        spread = F.aggregate("_seen", F.lit(0.0), lambda acc, x: acc + F.abs(x - F.col("_mean"))) / n
        s = s.add({f"cci_{n}": ratio(F.col("_tp") - F.col("_mean"), spread * 0.015)})
        return s.drop("_tp", "_mean", "_seen")

    return Step(build, n - 1)


# -- range and direction -------------------------------------------------------------------------


def _true_range(s: Series) -> Column:
    before = s.lag("close")
    return F.greatest(  # greatest skips the NULLs of the first row
        F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)
    )


def atr(n: int = 14) -> Step:
    def build(s: Series) -> Series:
        s = s.add({"_tr": _true_range(s)})
        return _wilder({f"atr_{n}": "_tr"}, n, seed_row=n)(s).drop("_tr")

    return Step(build, memory(1 - 1 / n) + 1)


def adx(n: int = 14) -> Step:
    """Directional indices and their smoothed difference."""
    pos, neg, out = f"adx_pos_{n}", f"adx_neg_{n}", f"adx_{n}"

    def build(s: Series) -> Series:
        s = s.add({
            "_tr": _true_range(s),
            "_rise": F.col("high") - s.lag("high"),
            "_fall": s.lag("low") - F.col("low"),
        })
        rise, fall = F.col("_rise"), F.col("_fall")
        s = s.add({
            "_pdm": F.when((rise > fall) & (rise > 0), rise).otherwise(F.lit(0.0)),
            "_ndm": F.when((fall > rise) & (fall > 0), fall).otherwise(F.lit(0.0)),
        })
        s = _wilder({"_atr": "_tr", "_p": "_pdm", "_n": "_ndm"}, n, seed_row=n)(s)
        s = s.add({pos: ratio(F.col("_p"), F.col("_atr")) * 100, neg: ratio(F.col("_n"), F.col("_atr")) * 100})
        gap = ratio(F.abs(F.col(pos) - F.col(neg)), F.col(pos) + F.col(neg)) * 100
        s = s.add({"_dx": from_row(n, F.coalesce(gap, F.lit(0.0)))})
        s = _wilder({out: "_dx"}, n, seed_row=2 * n - 1)(s)
        return s.drop("_tr", "_rise", "_fall", "_pdm", "_ndm", "_atr", "_p", "_n", "_dx")

    return Step(build, 2 * memory(1 - 1 / n) + 1)


def ichimoku(fast: int = 9, medium: int = 26, slow: int = 52) -> Step:
    """Unshifted leading spans A and B."""

    def build(s: Series) -> Series:
        def mid(n: int) -> Column:
            return from_row(n, (F.max("high").over(s.last_rows(n)) + F.min("low").over(s.last_rows(n))) / 2)

        return s.add({"ichimoku_a": (mid(fast) + mid(medium)) / 2, "ichimoku_b": mid(slow)})

    return Step(build, slow - 1)


# -- volume --------------------------------------------------------------------------------------


def obv() -> Step:
    def build(s: Series) -> Series:
        move = F.signum(F.col("close") - s.lag("close")) * F.col("volume")
        s = s.add({"_move": F.coalesce(move, F.lit(0.0))})
        return s.running(F.sum, {"obv": "_move"}, lambda a, b: a + b).drop("_move")

    return Step(build, 1)


def mfi(n: int = 14) -> Step:
    def build(s: Series) -> Series:
        s = s.add({"_tp": (F.col("high") + F.col("low") + F.col("close")) / 3})
        s = s.add({"_before": s.lag("_tp")})
        flow = F.col("_tp") * F.col("volume")
        s = s.add({
            "_in": F.when(F.col("_tp") > F.col("_before"), flow).otherwise(F.lit(0.0)),
            "_out": F.when(F.col("_tp") < F.col("_before"), flow).otherwise(F.lit(0.0)),
        })
        w = s.last_rows(n)
        s = s.add({"_in": F.sum("_in").over(w), "_out": F.sum("_out").over(w)})
        value = F.when(F.col("_out") == 0, F.lit(100.0)).otherwise(
            100 - F.lit(100.0) / (1 + ratio(F.col("_in"), F.col("_out"))))
        return s.add({f"mfi_{n}": from_row(n, value)}).drop("_tp", "_before", "_in", "_out")

    return Step(build, n)


def chaikin_flow(n: int = 20) -> Step:
    def build(s: Series) -> Series:
        place = ratio((F.col("close") - F.col("low")) - (F.col("high") - F.col("close")), F.col("high") - F.col("low"))
        s = s.add({"_mfv": F.coalesce(place, F.lit(0.0)) * F.col("volume")})
        w = s.last_rows(n)
        value = ratio(F.sum("_mfv").over(w), F.sum("volume").over(w))
        return s.add({f"cmf_{n}": from_row(n, value)}).drop("_mfv")

    return Step(build, n - 1)


def volume_ratio(n: int = 14) -> Step:
    def build(s: Series) -> Series:
        s = s.add({f"volume_sma_{n}": s.warm(n, F.avg("volume").over(s.last_rows(n)), "volume")})
        return s.add({"volume_ratio": ratio(F.col("volume"), F.col(f"volume_sma_{n}"))})

    return Step(build, n - 1)


# -- returns -------------------------------------------------------------------------------------


def daily_return(column: str = "close") -> Step:
    return Step(lambda s: s.add({"daily_return": (ratio(F.col(column), s.lag(column)) - 1) * 100}), 1)


def cumulative_return(column: str = "close") -> Step:
    """Compounded daily return in percent; the product telescopes to price over first price."""

    def build(s: Series) -> Series:
        s = s.join_series(F.min_by(column, RN).alias("_first"))
        value = (ratio(F.col(column), F.col("_first")) - 1) * 100
        return s.add({"cumulative_return": F.when(F.col(RN) > 1, value)}).drop("_first")

    return Step(build)


def volatility(n: int = 20, column: str = "daily_return", out: str | None = None, scale: float = 1.0) -> Step:
    name = out or f"volatility_{n}d"
    return Step(lambda s: s.add({name: s.warm(n, F.stddev_samp(column).over(s.last_rows(n)), column) * scale}), n - 1)


def log_return(column: str = "close") -> Step:
    return Step(lambda s: s.add({"log_return": F.log(ratio(F.col(column), s.lag(column)))}), 1)


def crypto_volatility(windows: tuple[int, ...] = (7, 14, 30, 90)) -> list[Step]:
    """Annualised deviation of log returns; needs ``log_return`` from an earlier stage."""
    year = math.sqrt(365)
    steps = [volatility(n, "log_return", f"volatility_{n}d", year) for n in windows]
    return [*steps, volatility(30, "log_return", "hist_volatility_30d", year)]


def period_return(n: int, column: str = "close") -> Step:
    return Step(lambda s: s.add({f"return_{n}d": ratio(F.col(column), s.lag(column, n)) - 1}), n)


def normalized_range(n: int = 7) -> Step:
    def build(s: Series) -> Series:
        s = s.add({"norm_range": ratio(F.col("high") - F.col("low"), F.col("close"))})
        return s.add({f"norm_range_{n}d_avg": s.warm(n, F.avg("norm_range").over(s.last_rows(n)), "norm_range")})

    return Step(build, n - 1)


# -- coins ---------------------------------------------------------------------------------------


def ohlc_from_price() -> Step:
    """Bars from a price series: open is the previous price, high and low stretch by 0.2 %."""

    def build(s: Series) -> Series:
        s = s.add({"close": F.col("price"), "open": F.coalesce(s.lag("price"), F.col("price"))})
        return s.add({
            "high": F.greatest("open", "close") * 1.002,
            "low": F.least("open", "close") * 0.998,
        })

    return Step(build, 1)


def nvt(n: int = 14) -> Step:
    def build(s: Series) -> Series:
        s = s.add({"nvt_ratio": ratio(F.col("market_cap"), F.col("volume"))})
        return s.add({"nvt_signal": s.warm(n, F.avg("nvt_ratio").over(s.last_rows(n)), "nvt_ratio")})

    return Step(build, n - 1)


def drawdown(column: str = "close") -> Step:
    """Highest price so far and the distance to it in percent."""

    def build(s: Series) -> Series:
        s = s.running(F.max, {"rolling_max": column}, F.greatest)
        return s.add({"drawdown_from_ath": (ratio(F.col(column), F.col("rolling_max")) - 1) * 100})

    return Step(build)
