"""Cleaning, indicator and signal queries with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries import adapters as a
from tidemark.operators import cleaning as cl
from tidemark.operators import indicators as ind
from tidemark.operators import signals as sig
from tidemark.operators.asof import nearest_by_date
from tidemark.operators.series import compute, lay_out

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def pick(df: DataFrame, digits: int, *columns: str, keys=("symbol", "date"), flags=()) -> DataFrame:
    return df.select(*keys, *[F.round(c, digits).alias(c) for c in columns], *flags)


def rounded(digits: int, *columns: str) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)


def win(n: int, part: str = "symbol") -> str:
    return f"over (partition by {part} order by rn rows between {n - 1} preceding and current row)"


LAG = "over (partition by symbol order by rn)"


def warm(n: int, expr: str, alias: str) -> str:
    return f"case when rn >= {n} then {expr} {win(n)} end as {alias}"


# -- averages and bands --------------------------------------------------------------------------


@query("sma", f"with {a.BARS_RN} select symbol, date, " + ", ".join(
    f"round({warm(n, 'avg(close)', '').removesuffix(' as ')}, 6) as sma_{n}" for n in (20, 50, 200)) + " from b")
def sma(spark, d):
    return pick(compute(a.bars_daily(spark, d), [ind.sma(20), ind.sma(50), ind.sma(200)]), 6, "sma_20", "sma_50", "sma_200")


@query("bollinger", f"""with {a.BARS_RN}, m as (select *, {warm(20, 'avg(close)', 'mid')}, {warm(20, 'stddev_pop(close)', 'dev')} from b)
select symbol, date, round(mid, 6) as bb_mid_20, round(mid + 2*dev, 4) as bb_high_20, round(mid - 2*dev, 4) as bb_low_20,
  round((close - (mid - 2*dev)) / nullif(4*dev, 0), 6) as bb_pct_b_20, round(4*dev/mid, 6) as bb_width_20 from m""")
def bollinger(spark, d):
    out = compute(a.bars_daily(spark, d), ind.bollinger(20, pct_b="bb_pct_b_20", width="bb_width_20"))
    return out.select("symbol", "date", F.round("bb_mid_20", 6).alias("bb_mid_20"),
                      *[F.round(c, 4).alias(c) for c in ("bb_high_20", "bb_low_20")],
                      *[F.round(c, 6).alias(c) for c in ("bb_pct_b_20", "bb_width_20")])


@query("trend_label", f"""with {a.BARS_RN}, m as (select *, {warm(20, 'avg(close)', 'm20')} from b),
r as (select *, round(m20, 6) as sma_20, lag(round(m20, 6)) {LAG} as p from m)
select symbol, date, (coalesce(close > sma_20 and sma_20 > p, false))::int as uptrend,
  (coalesce(close < sma_20 and sma_20 < p, false))::int as downtrend,
  (coalesce(close > sma_20 and sma_20 > p, false))::int - (coalesce(close < sma_20 and sma_20 < p, false))::int as trend_label from r""")
def trend_label(spark, d):
    out = compute(a.bars_daily(spark, d), ind.sma(20), ROUND("sma_20", 6), sig.trend_label())
    return out.select("symbol", "date", "uptrend", "downtrend", "trend_label")


def ROUND(column: str, digits: int):
    """Round before comparing, so both engines compare equal inputs."""
    from tidemark.operators.series import Step

    return Step(lambda s: s.add({column: F.round(column, digits)}))


@query("many_series_indicators", f"""with {a.MANY_SERIES} select symbol, date, round({warm(10, 'avg(close)', '').removesuffix(' as ')}, 6) as sma_10,
  round(case when rn >= 10 then case when max(high) {win(10)} = min(low) {win(10)} then null else -100 * (max(high) {win(10)} - close) / (max(high) {win(10)} - min(low) {win(10)}) end end, 4) as williams_r_10,
  round((close / lag(close, 10) {LAG} - 1) * 100, 4) as roc_10 from b""")
def many_series_indicators(spark, d):
    return compute(a.many_series(spark, d), [ind.sma(10), ind.williams_r(10), ind.roc(10)]).select(
        "symbol", "date", F.round("sma_10", 6).alias("sma_10"), *[F.round(c, 4).alias(c) for c in ("williams_r_10", "roc_10")])


# -- cleaning ------------------------------------------------------------------------------------


def kept(spark, d):
    return cl.dedupe_first(a.bars_daily_dirty(spark, d), ["seq"]).drop("seq")


@query("dedupe_first", f"with {a.BARS_DIRTY} select symbol, date, open, high, low, close, volume from kept")
def dedupe_first(spark, d):
    return kept(spark, d)


NEAR = """n as (select *,
    last_value(case when close is not null then rn end ignore nulls) over (partition by symbol order by rn) as prn,
    last_value(close ignore nulls) over (partition by symbol order by rn) as p,
    first_value(case when close is not null then rn end ignore nulls) over (partition by symbol order by rn rows between current row and unbounded following) as nrn,
    first_value(close ignore nulls) over (partition by symbol order by rn rows between current row and unbounded following) as nx
  from d),
filled as (select * replace (coalesce(close, case when p is null then nx when nx is null then p
    else p + (nx - p) * ((rn - prn)::double / (nrn - prn)) end) as close) from n)"""


@query("interpolate_gaps", f"with {a.BARS_DIRTY}, {NEAR} select symbol, date, round(close, 4) as close from filled")
def interpolate_gaps(spark, d):
    return pick(cl.interpolate(lay_out(kept(spark, d)), ["close"]).rows(), 4, "close")


@query("ffill_bfill", f"with {a.BARS_DIRTY}, {NEAR} select symbol, date, coalesce(p, nx) as close from n")
def ffill_bfill(spark, d):
    return cl.fill_forward(lay_out(kept(spark, d)), ["close"]).rows().select("symbol", "date", "close")


@query("drop_missing", f"with {a.BARS_DIRTY} select symbol, date, open, high, low, close, volume from kept where close is not null")
def drop_missing(spark, d):
    return cl.drop_missing(kept(spark, d))


def capped_sql(source: str, columns: tuple[str, ...], z: float, lo: float, hi: float) -> str:
    stats = ", ".join(
        f"avg({c}) as a_{c}, stddev_pop({c}) as s_{c}, quantile_cont({c}, {lo}) as l_{c}, quantile_cont({c}, {hi}) as h_{c}"
        for c in columns)
    out = ", ".join(
        f"case when abs(({c} - a_{c}) / nullif(s_{c}, 0)) > {z} and {c} > h_{c} then h_{c} "
        f"when abs(({c} - a_{c}) / nullif(s_{c}, 0)) > {z} and {c} < l_{c} then l_{c} else {c} end as {c}" for c in columns)
    return f"""st as (select symbol, count(*) as n, {stats} from {source} group by symbol),
capped as (select symbol, date, {out} from {source} join st using (symbol))"""


@query("winsorize_stock", f"with {a.BARS_DIRTY}, {NEAR}, {capped_sql('filled', ('close', 'volume'), 3.0, 0.05, 0.95)} "
       "select symbol, date, round(close, 4) as close, round(volume, 4) as volume from capped")
def winsorize_stock(spark, d):
    s = cl.interpolate(lay_out(kept(spark, d)), ["close"])
    return pick(cl.winsorize(s, ["close", "volume"], cl.STOCK_OUTLIERS).rows(), 4, "close", "volume")


@query("winsorize_crypto", f"with {a.COIN_RN}, {capped_sql('c', ('price', 'volume', 'market_cap'), 4.0, 0.0025, 0.9975)} "
       "select symbol, date, round(price, 4) as price, round(volume, 4) as volume, round(market_cap, 4) as market_cap from capped")
def winsorize_crypto(spark, d):
    s = lay_out(a.coin_daily(spark, d))
    return pick(cl.winsorize(s, ["price", "volume", "market_cap"], cl.CRYPTO_OUTLIERS).rows(), 4, "price", "volume", "market_cap")


@query("clamp_negative", f"with {a.BARS_DIRTY} select symbol, date, case when volume < 0 then 0 else volume end as volume from kept")
def clamp_negative(spark, d):
    return cl.clamp(kept(spark, d), ["volume"]).select("symbol", "date", "volume")


@query("swap_high_low", f"with {a.BARS_DIRTY} select symbol, date, case when high < low then low else high end as high, case when high < low then high else low end as low from kept")
def swap_high_low(spark, d):
    return cl.order_high_low(kept(spark, d)).select("symbol", "date", "high", "low")


@query("clean_stock", f"""with {a.BARS_DIRTY}, {NEAR}, {capped_sql('filled', cl.OHLCV, 3.0, 0.05, 0.95)},
v as (select * replace (case when volume < 0 then 0 else volume end as volume, greatest(high, low) as high, least(high, low) as low) from capped)
select symbol, date, {rounded(4, *cl.OHLCV)} from v""")
def clean_stock(spark, d):
    return pick(cl.clean_stock_data(a.bars_daily_dirty(spark, d), tie=["seq"]), 4, *cl.OHLCV)


@query("clean_crypto", f"""with {a.COIN_RN}, {capped_sql('c', cl.COIN, 4.0, 0.0025, 0.9975)}
select symbol, date, {', '.join(f'round(greatest({x}, 0), 4) as {x}' for x in cl.COIN)} from capped""")
def clean_crypto(spark, d):
    return pick(cl.clean_crypto_data(a.coin_daily(spark, d)), 4, *cl.COIN)


PER = "over (partition by symbol)"


@query("scale_minmax", f"with {a.BARS_RN} select symbol, date, round(coalesce((close - min(close) {PER}) / nullif(max(close) {PER} - min(close) {PER}, 0), 0), 6) as close from b")
def scale_minmax(spark, d):
    return pick(cl.scale_minmax(a.bars_daily(spark, d), ["close"]), 6, "close")


@query("scale_standard", f"with {a.BARS_RN} select symbol, date, round(coalesce((close - avg(close) {PER}) / nullif(stddev_pop(close) {PER}, 0), 0), 6) as close from b")
def scale_standard(spark, d):
    return pick(cl.scale_standard(a.bars_daily(spark, d), ["close"]), 6, "close")


@query("scale_log", f"""with {a.BARS_DIRTY}, m as (select *, min(volume) {PER} as lv from kept)
select symbol, date, round(ln(open), 6) as open, round(ln(case when lv <= 0 then volume + abs(lv) + 1 else volume end), 6) as volume from m""")
def scale_log(spark, d):
    return pick(cl.scale_log(kept(spark, d), ["open", "volume"]), 6, "open", "volume")


@query("pct_change", f"""with {a.BARS_RN}, p as (select *, (close / lag(close) {LAG} - 1) * 100 as pc from b)
select symbol, date, close, round(pc, 6) as close_pct_change from p where rn > 1""")
def pct_change(spark, d):
    return cl.percent_change(a.bars_daily(spark, d), ["close"]).select("symbol", "date", "close", F.round("close_pct_change", 6).alias("close_pct_change"))


# -- exponential family --------------------------------------------------------------------------

BARS_REC = a.BARS_RN.replace("bars as (", "bars as materialized (", 1).replace("b as (", "b as materialized (", 1)


def ema_sql(*spans: int, column: str = "close", source: str = "b") -> str:
    """Recursive scan with one state column per span."""
    first = ", ".join(f"{column}::double as e{n}" for n in spans)
    then = ", ".join(f"{source}.{column} * {2 / (n + 1)!r} + e{n} * {1 - 2 / (n + 1)!r} as e{n}" for n in spans)
    return f"""e as (select symbol, rn, {first} from {source} where rn = 1
  union all select {source}.symbol, {source}.rn, {then} from e join {source} on {source}.symbol = e.symbol and {source}.rn = e.rn + 1)"""


@query("ema", f"with recursive {BARS_REC}, {ema_sql(12, 26, 50)} select symbol, date, " + ", ".join(
    f"round(case when rn >= {n} then e{n} end, 4) as ema_{n}" for n in (12, 26, 50)) + " from e join b using (symbol, rn)")
def ema(spark, d):
    return pick(compute(a.bars_daily(spark, d), [ind.ema(12), ind.ema(26), ind.ema(50)]), 4, "ema_12", "ema_26", "ema_50")


RSI_REC = f"""ch as materialized (select symbol, date, rn, close, coalesce(close - lag(close) {LAG}, 0) as dx from b),
g as (select symbol, rn, 0.0::double as up, 0.0::double as dn from ch where rn = 1
  union all select ch.symbol, ch.rn, up * (13.0/14) + greatest(dx, 0) / 14.0, dn * (13.0/14) + greatest(-dx, 0) / 14.0
  from g join ch on ch.symbol = g.symbol and ch.rn = g.rn + 1),
rs as (select symbol, rn, ch.date, ch.close, case when rn >= 14 then case when dn = 0 then 100 else 100 - 100 / (1 + up / dn) end end as rsi_14
  from g join ch using (symbol, rn))"""


@query("rsi", f"with recursive {BARS_REC}, {RSI_REC} select symbol, date, round(rsi_14, 4) as rsi_14 from rs")
def rsi(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.rsi(14)), 4, "rsi_14")


MACD_REC = f"""{ema_sql(12, 26)},
li as materialized (select symbol, rn, e12 - e26 as line from e where rn >= 26),
sg as (select symbol, rn, line, line as signal from li where rn = 26
  union all select li.symbol, li.rn, li.line, li.line * 0.2 + sg.signal * 0.8 from sg join li on li.symbol = sg.symbol and li.rn = sg.rn + 1),
mc as (select b.symbol, b.date, b.rn, sg.line as macd_12_26_9, case when b.rn >= 34 then signal end as macd_signal_12_26_9
  from b left join sg on b.symbol = sg.symbol and b.rn = sg.rn)"""


@query("macd", f"""with recursive {BARS_REC}, {MACD_REC} select symbol, date, round(macd_12_26_9, 4) as macd_12_26_9,
round(macd_signal_12_26_9, 4) as macd_signal_12_26_9, round(macd_12_26_9 - macd_signal_12_26_9, 4) as macd_hist_12_26_9 from mc""")
def macd(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.macd()), 4, "macd_12_26_9", "macd_signal_12_26_9", "macd_hist_12_26_9")


TR_SQL = f"""t as materialized (select *, greatest(high - low, abs(high - lag(close) {LAG}), abs(low - lag(close) {LAG})) as tr,
  coalesce(case when high - lag(high) {LAG} > lag(low) {LAG} - low and high - lag(high) {LAG} > 0 then high - lag(high) {LAG} end, 0) as pdm,
  coalesce(case when lag(low) {LAG} - low > high - lag(high) {LAG} and lag(low) {LAG} - low > 0 then lag(low) {LAG} - low end, 0) as ndm from b),
seed as (select symbol, avg(tr) as tr, avg(pdm) as pdm, avg(ndm) as ndm from t where rn <= 14 group by symbol having count(*) = 14),
w as (select symbol, 14::bigint as rn, tr as str, pdm as sp, ndm as sn from seed
  union all select t.symbol, t.rn, w.str * (13.0/14) + t.tr / 14.0, w.sp * (13.0/14) + t.pdm / 14.0, w.sn * (13.0/14) + t.ndm / 14.0
  from w join t on t.symbol = w.symbol and t.rn = w.rn + 1)"""


@query("atr", f"with recursive {BARS_REC}, {TR_SQL} select b.symbol, b.date, round(str, 4) as atr_14 from b left join w on b.symbol = w.symbol and b.rn = w.rn")
def atr(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.atr(14)), 4, "atr_14")


ADX_SQL = f"""{TR_SQL},
di as materialized (select symbol, rn, sp / nullif(str, 0) * 100 as pos, sn / nullif(str, 0) * 100 as neg,
  coalesce(abs(sp / nullif(str, 0) * 100 - sn / nullif(str, 0) * 100) / nullif(sp / nullif(str, 0) * 100 + sn / nullif(str, 0) * 100, 0) * 100, 0) as dx from w),
ax0 as (select symbol, avg(dx) as x from di where rn <= 27 group by symbol having count(*) = 14),
ax as (select symbol, 27::bigint as rn, x from ax0
  union all select di.symbol, di.rn, ax.x * (13.0/14) + di.dx / 14.0 from ax join di on di.symbol = ax.symbol and di.rn = ax.rn + 1),
adxes as (select b.symbol, b.date, b.rn, x as adx_14, pos as adx_pos_14, neg as adx_neg_14
  from b left join di on di.symbol = b.symbol and di.rn = b.rn left join ax on ax.symbol = b.symbol and ax.rn = b.rn)"""


@query("adx", f"with recursive {BARS_REC}, {ADX_SQL} select symbol, date, {rounded(4, 'adx_14', 'adx_pos_14', 'adx_neg_14')} from adxes")
def adx(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.adx(14)), 4, "adx_14", "adx_pos_14", "adx_neg_14")


@query("ema_order", f"""with recursive {BARS_REC}, {ema_sql(9, 21, 50)},
z as (select symbol, round(e9, 4) as e9, round(e21, 4) as e21, round(e50, 4) as e50 from e qualify rn = max(rn) over (partition by symbol) and rn > 50)
select symbol, e9 as ema_9, e21 as ema_21, e50 as ema_50, case when e9 > e21 and e21 > e50 then 'strong_uptrend' when e9 < e21 and e21 < e50 then 'strong_downtrend'
  when e9 > e21 and e21 < e50 then 'potential_reversal_up' when e9 < e21 and e21 > e50 then 'potential_reversal_down' else 'mixed_sideways' end as ema_trend from z""")
def ema_order(spark, d):
    from tidemark.operators.trend import ema_order as op

    return op(a.bars_daily(spark, d), digits=4)


# -- other indicators ----------------------------------------------------------------------------


@query("volatility", f"""with {a.BARS_RN}, r as (select *, (close / lag(close) {LAG} - 1) * 100 as daily_return from b)
select symbol, date, round(daily_return, 6) as daily_return, round(case when rn >= 21 then stddev_samp(daily_return) {win(20)} end, 4) as volatility_20d from r""")
def volatility(spark, d):
    out = compute(a.bars_daily(spark, d), ind.daily_return(), ind.volatility(20))
    return out.select("symbol", "date", F.round("daily_return", 6).alias("daily_return"), F.round("volatility_20d", 4).alias("volatility_20d"))


STOCH_SQL = f"""k as (select *, case when rn >= 14 then 100 * (close - min(low) {win(14)}) / nullif(max(high) {win(14)} - min(low) {win(14)}, 0) end as kk from b),
st as (select *, case when count(kk) {win(3)} = 3 then avg(kk) {win(3)} end as dd from k)"""


@query("stochastic", f"with {a.BARS_RN}, {STOCH_SQL} select symbol, date, round(kk, 4) as stoch_k_14, round(dd, 4) as stoch_d_14_3 from st")
def stochastic(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.stochastic()), 4, "stoch_k_14", "stoch_d_14_3")


@query("obv", f"""with {a.BARS_RN}, m as (select *, coalesce(sign(close - lag(close) {LAG}) * volume, 0) as mv from b)
select symbol, date, sum(mv) over (partition by symbol order by rn) as obv from m""")
def obv(spark, d):
    return compute(a.bars_daily(spark, d), ind.obv()).select("symbol", "date", "obv")


@query("cci", f"""with {a.BARS_RN}, t as (select *, (high + low + close) / 3 as tp from b),
m as (select *, {warm(20, 'avg(tp)', 'mean')}, list(tp) {win(20)} as seen from t)
select symbol, date, round((tp - mean) / nullif(0.015 * list_avg(list_transform(seen, lambda x: abs(x - mean))), 0), 4) as cci_20 from m""")
def cci(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.cci()), 4, "cci_20")


@query("williams_r", f"with {a.BARS_RN} select symbol, date, round(case when rn >= 14 then -100 * (max(high) {win(14)} - close) / nullif(max(high) {win(14)} - min(low) {win(14)}, 0) end, 4) as williams_r_14 from b")
def williams_r(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.williams_r()), 4, "williams_r_14")


@query("roc", f"with {a.BARS_RN} select symbol, date, " + ", ".join(f"round((close / lag(close, {n}) {LAG} - 1) * 100, 4) as roc_{n}" for n in (1, 7, 10, 21, 90)) + " from b")
def roc(spark, d):
    return pick(compute(a.bars_daily(spark, d), [ind.roc(n) for n in (1, 7, 10, 21, 90)]), 4, "roc_1", "roc_7", "roc_10", "roc_21", "roc_90")


@query("mfi", f"""with {a.BARS_RN}, t as (select *, (high + low + close) / 3 as tp from b), p as (select *, lag(tp) {LAG} as bp from t),
f as (select *, case when tp > bp then tp * volume else 0 end as i, case when tp < bp then tp * volume else 0 end as o from p),
g as (select symbol, date, rn, sum(i) {win(14)} as i, sum(o) {win(14)} as o, count(case when o <> 0 then 1 end) {win(14)} as anyo from f)
select symbol, date, round(case when rn >= 14 then case when anyo = 0 then 100 else 100 - 100 / (1 + i / o) end end, 4) as mfi_14 from g""")
def mfi(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.mfi()), 4, "mfi_14")


def mid_sql(n: int) -> str:
    return f"case when rn >= {n} then (max(high) {win(n)} + min(low) {win(n)}) / 2 end"


@query("ichimoku", f"with {a.BARS_RN} select symbol, date, round(({mid_sql(9)} + {mid_sql(26)}) / 2, 4) as ichimoku_a, round({mid_sql(52)}, 4) as ichimoku_b from b")
def ichimoku(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.ichimoku()), 4, "ichimoku_a", "ichimoku_b")


@query("returns", f"""with {a.BARS_RN}, r as (select *, close / lag(close) {LAG} - 1 as x from b)
select symbol, date, round(x * 100, 4) as daily_return, round((product(1 + x) over (partition by symbol order by rn) - 1) * 100, 4) as cumulative_return from r""")
def returns(spark, d):
    return pick(compute(a.bars_daily(spark, d), [ind.daily_return(), ind.cumulative_return()]), 4, "daily_return", "cumulative_return")


@query("log_returns", f"""with {a.COIN_RN}, r as (select *, ln(price / lag(price) {LAG}) as lr from c)
select symbol, date, round(lr, 6) as log_return, """ + ", ".join(
    f"round(case when rn > {n} then stddev_samp(lr) {win(n)} * sqrt(365) end, 4) as volatility_{n}d" for n in (7, 14, 30, 90)) + ", " + ", ".join(
    f"round(price / lag(price, {n}) {LAG} - 1, 6) as return_{n}d" for n in (7, 14, 30, 90)) + " from r")
def log_returns(spark, d):
    out = compute(a.coin_daily(spark, d), [ind.log_return("price"), *[ind.period_return(n, "price") for n in (7, 14, 30, 90)]], ind.crypto_volatility())
    return out.select("symbol", "date", F.round("log_return", 6).alias("log_return"),
                      *[F.round(f"volatility_{n}d", 4).alias(f"volatility_{n}d") for n in (7, 14, 30, 90)],
                      *[F.round(f"return_{n}d", 6).alias(f"return_{n}d") for n in (7, 14, 30, 90)])


OHLC_SQL = f"""o as (select symbol, date, rn, price as close, volume, market_cap, coalesce(lag(price) {LAG}, price) as open from c),
x as (select *, greatest(open, close) * 1.002::double as high, least(open, close) * 0.998::double as low from o)"""


@query("ohlc_synthesis", f"with {a.COIN_RN}, {OHLC_SQL} select symbol, date, {rounded(6, 'open', 'high', 'low', 'close')} from x")
def ohlc_synthesis(spark, d):
    return pick(compute(a.coin_daily(spark, d), ind.ohlc_from_price()), 6, "open", "high", "low", "close")


@query("norm_range", f"""with {a.COIN_RN}, {OHLC_SQL}, r as (select *, (high - low) / close as nr from x)
select symbol, date, round(nr, 6) as norm_range, round({warm(7, 'avg(nr)', '').removesuffix(' as ')}, 6) as norm_range_7d_avg from r""")
def norm_range(spark, d):
    return pick(compute(a.coin_daily(spark, d), ind.ohlc_from_price(), ind.normalized_range()), 6, "norm_range", "norm_range_7d_avg")


@query("nvt", f"""with {a.COIN_RN}, r as (select *, market_cap / nullif(volume, 0) as nr from c)
select symbol, date, round(nr, 6) as nvt_ratio, round({warm(14, 'avg(nr)', '').removesuffix(' as ')}, 6) as nvt_signal from r""")
def nvt(spark, d):
    return pick(compute(a.coin_daily(spark, d), ind.nvt()), 6, "nvt_ratio", "nvt_signal")


@query("dominance_asof", f"""with {a.COIN_DAILY}, {a.COIN_TOTAL},
days as (select distinct date from coins),
near as (select days.date, arg_min(total_market_cap, abs(date_diff('day', totals.date, days.date)) * 2 - (case when totals.date > days.date then 1 else 0 end)) as total_market_cap
  from days, totals group by 1)
select symbol, date, total_market_cap, round(market_cap / total_market_cap * 100, 6) as market_dominance from coins join near using (date)""")
def dominance_asof(spark, d):
    out = nearest_by_date(a.coin_daily(spark, d), a.coin_market_total(spark, d), "total_market_cap")
    share = F.try_divide("market_cap", "total_market_cap") * 100
    return out.select("symbol", "date", "total_market_cap", F.round(share, 6).alias("market_dominance"))


@query("volume_ratio", f"""with {a.BARS_HOURLY}, r as (select *, {warm(14, 'avg(volume)', 'v')} from b)
select symbol, ts, round(v, 6) as volume_sma_14, round(volume / nullif(v, 0), 6) as volume_ratio from r""")
def volume_ratio(spark, d):
    return pick(compute(a.bars_hourly(spark, d), ind.volume_ratio(), order="ts"), 6, "volume_sma_14", "volume_ratio", keys=("symbol", "ts"))


@query("cmf", f"""with {a.BARS_RN}, m as (select *, coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0) * volume as mf from b)
select symbol, date, round(case when rn >= 20 then sum(mf) {win(20)} / nullif(sum(volume) {win(20)}, 0) end, 6) as cmf_20 from m""")
def cmf(spark, d):
    return pick(compute(a.bars_daily(spark, d), ind.chaikin_flow()), 6, "cmf_20")


@query("drawdown", f"""with {a.BARS_RN}, m as (select *, max(close) over (partition by symbol order by rn) as rolling_max from b)
select symbol, date, rolling_max, round((close / rolling_max - 1) * 100, 6) as drawdown_from_ath from m""")
def drawdown(spark, d):
    return compute(a.bars_daily(spark, d), ind.drawdown()).select("symbol", "date", "rolling_max", F.round("drawdown_from_ath", 6).alias("drawdown_from_ath"))


# -- signals -------------------------------------------------------------------------------------


def up_sql(x: str, y: str) -> str:
    py = y if y.replace(".", "").isdigit() else f"lag({y}) {LAG}"
    return f"(coalesce({x} > {y} and lag({x}) {LAG} <= {py}, false))::int"


def down_sql(x: str, y: str) -> str:
    py = y if y.replace(".", "").isdigit() else f"lag({y}) {LAG}"
    return f"(coalesce({x} < {y} and lag({x}) {LAG} >= {py}, false))::int"


@query("ma_cross", f"""with {a.BARS_RN}, m as (select *, round({warm(50, 'avg(close)', '').removesuffix(' as ')}, 6) as f, round({warm(200, 'avg(close)', '').removesuffix(' as ')}, 6) as s from b)
select symbol, date, {up_sql('f', 's')} as golden_cross, {down_sql('f', 's')} as death_cross from m""")
def ma_cross(spark, d):
    out = compute(a.bars_daily(spark, d), [ind.sma(50), ind.sma(200)], [ROUND("sma_50", 6), ROUND("sma_200", 6)], sig.ma_cross())
    return out.select("symbol", "date", "golden_cross", "death_cross")


@query("macd_cross", f"""with recursive {BARS_REC}, {MACD_REC}, m as (select symbol, date, rn, round(macd_12_26_9, 4) as l, round(macd_signal_12_26_9, 4) as s from mc)
select symbol, date, {up_sql('l', 's')} as macd_bull_cross, {down_sql('l', 's')} as macd_bear_cross from m""")
def macd_cross(spark, d):
    out = compute(a.bars_daily(spark, d), ind.macd(), [ROUND("macd_12_26_9", 4), ROUND("macd_signal_12_26_9", 4)], sig.macd_cross())
    return out.select("symbol", "date", "macd_bull_cross", "macd_bear_cross")


@query("rsi_signals", f"""with recursive {BARS_REC}, {RSI_REC}, m as (select symbol, date, rn, round(rsi_14, 4) as x from rs)
select symbol, date, (coalesce(x < 30, false))::int as rsi_oversold, (coalesce(x > 70, false))::int as rsi_overbought,
  {up_sql('x', '30')} as rsi_bull_cross, {down_sql('x', '70')} as rsi_bear_cross from m""")
def rsi_signals(spark, d):
    out = compute(a.bars_daily(spark, d), ind.rsi(14), ROUND("rsi_14", 4), sig.rsi_signals())
    return out.select("symbol", "date", "rsi_oversold", "rsi_overbought", "rsi_bull_cross", "rsi_bear_cross")


BAND_SQL = f"""bm as (select *, {warm(20, 'avg(close)', 'mid')}, {warm(20, 'stddev_pop(close)', 'dev')} from b),
bd as (select *, round(mid + 2*dev, 4) as hi, round(mid - 2*dev, 4) as lo from bm)"""


@query("bollinger_signals", f"""with {a.BARS_RN}, {BAND_SQL}
select symbol, date, (coalesce(close > hi, false))::int as bb_upper_break, (coalesce(close < lo, false))::int as bb_lower_break,
  {down_sql('close', 'hi')} as bb_upper_return, {up_sql('close', 'lo')} as bb_lower_return from bd""")
def bollinger_signals(spark, d):
    out = compute(a.bars_daily(spark, d), ind.bollinger(20), [ROUND("bb_high_20", 4), ROUND("bb_low_20", 4)], sig.bollinger_signals())
    return out.select("symbol", "date", "bb_upper_break", "bb_lower_break", "bb_upper_return", "bb_lower_return")


@query("stoch_signals", f"""with {a.BARS_RN}, {STOCH_SQL}, m as (select symbol, date, rn, round(kk, 4) as k, round(dd, 4) as d from st)
select symbol, date, {up_sql('k', 'd')} as stoch_bull_cross, {down_sql('k', 'd')} as stoch_bear_cross,
  (coalesce(k < 20 and d < 20, false))::int as stoch_oversold, (coalesce(k > 80 and d > 80, false))::int as stoch_overbought from m""")
def stoch_signals(spark, d):
    out = compute(a.bars_daily(spark, d), ind.stochastic(), [ROUND("stoch_k_14", 4), ROUND("stoch_d_14_3", 4)], sig.stochastic_signals())
    return out.select("symbol", "date", "stoch_bull_cross", "stoch_bear_cross", "stoch_oversold", "stoch_overbought")


@query("adx_strength", f"""with recursive {BARS_REC}, {ADX_SQL}, m as (select symbol, date, round(adx_14, 4) as x from adxes)
select symbol, date, (coalesce(x > 25, false))::int as strong_trend, (coalesce(x > 50, false))::int as very_strong_trend, (coalesce(x < 20, false))::int as weak_trend from m""")
def adx_strength(spark, d):
    out = compute(a.bars_daily(spark, d), ind.adx(14), ROUND("adx_14", 4), sig.adx_strength())
    return out.select("symbol", "date", "strong_trend", "very_strong_trend", "weak_trend")


@query("combined_signal", f"""with recursive {BARS_REC}, {MACD_REC}, {RSI_REC}, {BAND_SQL}, {STOCH_SQL},
m as (select symbol, rn, bd.date, bd.close, bd.hi, bd.lo, round(mc.macd_12_26_9, 4) as l, round(mc.macd_signal_12_26_9, 4) as s, round(rs.rsi_14, 4) as x, round(st.kk, 4) as k, round(st.dd, 4) as d
  from bd join mc using (symbol, rn) join rs using (symbol, rn) join st using (symbol, rn))
select symbol, date, {up_sql('l', 's')} + {up_sql('x', '30')} + {up_sql('close', 'lo')} + {up_sql('k', 'd')}
  - {down_sql('l', 's')} - {down_sql('x', '70')} - {down_sql('close', 'hi')} - {down_sql('k', 'd')} as combined_signal from m""")
def combined_signal(spark, d):
    rounds = [ROUND(c, 4) for c in ("macd_12_26_9", "macd_signal_12_26_9", "rsi_14", "bb_high_20", "bb_low_20", "stoch_k_14", "stoch_d_14_3")]
    out = compute(a.bars_daily(spark, d), [ind.macd(), ind.rsi(14), ind.bollinger(20), ind.stochastic()], rounds,
                  [sig.macd_cross(), sig.rsi_signals(), sig.bollinger_signals(), sig.stochastic_signals()], sig.combined_signal())
    return out.select("symbol", "date", "combined_signal")


EDGE = "over (partition by symbol order by rn rows between {} and {})"
LEFT, RIGHT = EDGE.format("10 preceding", "1 preceding"), EDGE.format("1 following", "10 following")


@query("local_extrema", f"""with {a.COIN_RN} select symbol, date,
  (coalesce(count(*) {LEFT} = 10 and count(*) {RIGHT} = 10 and price < min(price) {LEFT} and price < min(price) {RIGHT}, false))::int as local_bottom,
  (coalesce(count(*) {LEFT} = 10 and count(*) {RIGHT} = 10 and price > max(price) {LEFT} and price > max(price) {RIGHT}, false))::int as local_top from c""")
def local_extrema(spark, d):
    return compute(a.coin_daily(spark, d), sig.local_extrema(column="price")).select("symbol", "date", "local_bottom", "local_top")


COIN_REC = a.COIN_RN.replace("coins as (", "coins as materialized (", 1).replace("c as (", "cc as materialized (", 1) + ", b as materialized (select symbol, date, rn, price as close, volume, market_cap from cc)"
PHASE_SQL = f"""{ema_sql(9, 21)},
li as materialized (select symbol, rn, e9 - e21 as line from e where rn >= 21),
sg as (select symbol, rn, line, line as signal from li where rn = 21
  union all select li.symbol, li.rn, li.line, li.line * 0.2 + sg.signal * 0.8 from sg join li on li.symbol = sg.symbol and li.rn = sg.rn + 1),
{RSI_REC},
ph as (select b.symbol, b.date, b.rn, round(rsi_14, 4) as rsi, round(case when b.rn >= 29 then sg.line - signal end, 4) as hist,
    round((b.close / max(b.close) over (partition by b.symbol order by b.rn) - 1) * 100, 4) as down,
    round(case when b.rn >= 50 then avg(b.close) over (partition by b.symbol order by b.rn rows 49 preceding) end, 6) as s50,
    round(case when b.rn >= 200 then avg(b.close) over (partition by b.symbol order by b.rn rows 199 preceding) end, 6) as s200
  from b join rs using (symbol, rn) left join sg on sg.symbol = b.symbol and sg.rn = b.rn),
tr as (select *, case when s50 > s200 then 1 when s50 < s200 then -1 else 0 end as trend from ph)"""


def cycle_columns(spark, d, *last):
    rounds = [ROUND("rsi_14", 4), ROUND("macd_histogram", 4), ROUND("drawdown_from_ath", 4), ROUND("sma_50", 6), ROUND("sma_200", 6)]
    return compute(
        a.coin_daily(spark, d).withColumn("close", F.col("price")),
        [ind.rsi(14), ind.macd(9, 21, 9, names=("macd_line", "macd_signal", "macd_histogram")), ind.sma(50), ind.sma(200), ind.drawdown()],
        rounds, sig.cycle_trend(), *last)


@query("market_phase_flags", f"""with recursive {COIN_REC}, {PHASE_SQL} select symbol, date,
  (coalesce(trend = -1 and rsi > 50 and lag(rsi, 7) {LAG} < 45 and down < -20, false))::int as accumulation_phase,
  (coalesce(trend = 1 and rsi > 55 and hist > 0, false))::int as bullish_phase,
  (coalesce(down > -10 and rsi < 70 and lag(rsi, 7) {LAG} > 75 and hist < lag(hist, 7) {LAG}, false))::int as distribution_phase,
  (coalesce(trend = -1 and rsi < 45 and hist < 0, false))::int as bearish_phase from tr""")
def market_phase_flags(spark, d):
    return cycle_columns(spark, d, sig.phase_flags()).select(
        "symbol", "date", "accumulation_phase", "bullish_phase", "distribution_phase", "bearish_phase")


@query("market_cycle", f"""with recursive {COIN_REC}, {PHASE_SQL},
m as (select symbol, date, trend, case when down < -60 and trend = -1 then 1 when down < -20 and trend = 1 then 2 when down > -20 and trend = 1 then 3
  when down > -10 then 4 when down < -10 and trend = -1 then 5 else 0 end as market_cycle from tr)
select *, case market_cycle when 1 then 'Fondo de Mercado' when 2 then 'Recuperación' when 3 then 'Fase Alcista' when 4 then 'Euforia (Cerca de ATH)' when 5 then 'Fase Bajista' end as market_cycle_label from m""")
def market_cycle(spark, d):
    return cycle_columns(spark, d, sig.market_cycle()).select("symbol", "date", "trend", "market_cycle", "market_cycle_label")


@query("bubble_flag", f"""with {a.COIN_RN}, r as (select *, ln(price / lag(price) {LAG}) as lr from c),
v as (select *, round(case when rn > 30 then stddev_samp(lr) {win(30)} * sqrt(365) end, 6) as v, round(price / lag(price, 90) {LAG} - 1, 6) as r from r),
q as (select symbol, quantile_cont(v, 0.85) as qv, quantile_cont(r, 0.9) as qr from v group by symbol)
select symbol, date, (coalesce(v > qv and r > qr, false))::int as bubble_indicator from v join q using (symbol)""")
def bubble_flag(spark, d):
    out = compute(a.coin_daily(spark, d), [ind.log_return("price"), ind.period_return(90, "price")],
                  ind.volatility(30, "log_return", scale=365**0.5), [ROUND("volatility_30d", 6), ROUND("return_90d", 6)], sig.bubble_flag())
    return out.select("symbol", "date", "bubble_indicator")
