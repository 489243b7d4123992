"""Trend, level, seasonality and stationarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import adapters as a
from queries.prices import BARS_REC, LAG, RSI_REC, ema_sql, win
from tidemark.operators import seasonality as se
from tidemark.operators import stationarity as st
from tidemark.operators import trend as tr
from tidemark.operators.series import with_ordinal
from tidemark.session import staged

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def rnd(df, digits, *columns, keep=()):
    return df.select(*keep, *[F.round(c, digits).alias(c) for c in columns])


def bars(spark, d):
    """Bars written once: the analyses below read them several times."""
    return staged(a.bars_daily(spark, d))


def peaks_sql(source: str, key: str, pos: str, y: str, height: float, distance: int) -> str:
    """Strict local maxima (flat tops at their middle), thinned greedily by height, later first on a tie."""
    return f"""pk_n as (select *, case when lag({y}) over (partition by {key} order by {pos}) = {y} then 0 else 1 end as isnew from {source}),
pk_r as (select *, sum(isnew) over (partition by {key} order by {pos}) as run from pk_n),
pk_g as (select {key}, run, (min({pos}) + max({pos})) // 2 as {pos}, min({y}) as {y} from pk_r group by {key}, run),
pk_w as (select *, lag({y}) over (partition by {key} order by run) as l, lead({y}) over (partition by {key} order by run) as r from pk_g),
pk_o as (select {key}, {pos}, {y}, row_number() over (partition by {key} order by {y} desc, {pos} desc) as k from pk_w where l < {y} and r < {y} and {y} >= {height}),
pk_f as (select {key}, k, [{pos}] as kept from pk_o where k = 1
  union all select pk_o.{key}, pk_o.k, case when list_min(list_transform(kept, lambda q: abs(q - {pos}))) < {distance} then kept else list_append(kept, {pos}) end
  from pk_f join pk_o on pk_o.{key} = pk_f.{key} and pk_o.k = pk_f.k + 1),
pk_l as (select {key}, unnest(arg_max(kept, k)) as {pos} from pk_f group by {key}),
peaks as (select {key}, {pos}, {y} from pk_l join pk_o using ({key}, {pos}))"""


N = "count(*) over (partition by symbol) as n"


@query("slopes", f"""with {a.BARS_RN}, s as (select symbol, rn, {N}, case when rn >= 10 then avg(close) {win(10)} end as y from b),
t as (select s.*, w from s, (values (20), (40), (80)) v(w) where y is not null and n - rn < w and n - 9 >= w),
f as (select symbol, w, regr_slope(y, rn) as sl, coalesce(corr(y, rn), 0) as r, arg_min(y, rn) as y0 from t group by 1, 2)
select symbol, w as "window", round(sl, 6) as slope, round(sl / y0 * 100, 6) as normalized_slope, round(r * r, 6) as r_squared,
  case when sl > 0 then 'uptrend' else 'downtrend' end as direction, round(abs(r), 6) as strength from f""")
def slopes(spark, d):
    return rnd(tr.slopes(bars(spark, d), 20), 6, "slope", "normalized_slope", "r_squared", "strength", keep=("symbol", "window", "direction"))


SUMMARY = f"""sm as (select *, close / lag(close) {LAG} - 1 as ret, {N} from b),
su as (select symbol, max(n) as n, arg_min(close, rn) as start_value, arg_max(close, rn) as current_value, stddev_samp(ret) * 100 as volatility,
  max(close) filter (rn > n - 20) as hi, min(close) filter (rn > n - 20) as lo from sm group by symbol)"""


@query("series_summary", f"""with {a.BARS_RN}, {SUMMARY}
select symbol, n, start_value, current_value, round((current_value / start_value - 1) * 100, 4) as overall_change_pct, round(volatility, 4) as volatility,
  round(case when n > 20 then (current_value / hi - 1) * 100 end, 4) as percent_from_period_max,
  round(case when n > 20 then (current_value / lo - 1) * 100 end, 4) as percent_from_period_min from su""")
def series_summary(spark, d):
    out = tr.series_summary(bars(spark, d), 20)
    return rnd(out, 4, "overall_change_pct", "volatility", "percent_from_period_max", "percent_from_period_min", keep=("symbol", "n", "start_value", "current_value"))


ADJACENT = f"""fr as (select *, {N} from b),
ad as (select symbol, date, rn, n, close, {', '.join(f'''regr_slope(close, rn) over {w} / nullif(avg(close) over {w}, 0) as s{t}, coalesce(corr(close, rn) over {w}, 0) as r{t}''' for t, w in (('1', 'o'), ('2', 'f')))} from fr
  window o as (partition by symbol order by rn rows between 20 preceding and 1 preceding), f as (partition by symbol order by rn rows between current row and 19 following)),
ax as (select symbol, date, rn, close, round(coalesce(s1, 0), 8) as slope1, round(coalesce(s2, 0), 8) as slope2, round(r1, 8) as r1, round(r2, 8) as r2,
  round(abs(coalesce(s2, 0) - coalesce(s1, 0)) / (abs(coalesce(s1, 0)) + 1e-10), 8) as relative_change from ad where rn > 20 and rn <= n - 19)"""


@query("adjacent_slopes", f"with {a.BARS_RN}, {ADJACENT} select symbol, date, round(coalesce(s1, 0), 5) as slope1, round(coalesce(s2, 0), 5) as slope2, round(r1, 5) as r1, round(r2, 5) as r2 from ad where rn > 20 and rn <= n - 19")
def adjacent_slopes(spark, d):
    from tidemark.operators.series import compute

    out = compute(a.bars_daily(spark, d), tr.adjacent_slopes(20)).where("slope1 is not null and slope2 is not null")
    return rnd(out, 5, "slope1", "slope2", "r1", "r2", keep=("symbol", "date"))


OBV_REC = BARS_REC.replace("b as materialized (", "b0 as materialized (", 1) + f""",
b1 as (select symbol, date, rn, coalesce(sign(close - lag(close) {LAG}) * volume, 0) as mv from b0),
b as materialized (select symbol, date, rn, sum(mv) over (partition by symbol order by rn) as close from b1)"""


@query("trend_changes", f"""with recursive {OBV_REC}, {ADJACENT},
pv as (select *, lag(slope2) {LAG} as before_slope from ax),
cd as (select *, slope2 * before_slope < 0 as flip, row_number() over (partition by symbol order by rn) as k from pv
  where before_slope is not null and (slope2 * before_slope < 0 or relative_change > 0.15) and r1 * r1 > 0.6 and r2 * r2 > 0.6),
fold as (select symbol, k, [rn] as kept, relative_change as mag from cd where k = 1
  union all select cd.symbol, cd.k, case when cd.rn - fold.kept[-1] > 10 then list_append(fold.kept, cd.rn) when cd.relative_change > mag then list_append(fold.kept[:-2], cd.rn) else fold.kept end,
    case when cd.rn - fold.kept[-1] > 10 then cd.relative_change when cd.relative_change > mag then cd.relative_change else mag end
  from fold join cd on cd.symbol = fold.symbol and cd.k = fold.k + 1),
lastfold as (select symbol, unnest(arg_max(kept, k)) as rn from fold group by symbol)
select symbol, rn as pos, date, case when flip then 'reversal' else 'acceleration' end as type, round(relative_change, 2) as magnitude,
  round(before_slope, 6) as before_slope, round(slope2, 6) as after_slope, close as value,
  case when before_slope < 0 and slope2 > 0 then 'bullish_reversal' when before_slope > 0 and slope2 < 0 then 'bearish_reversal'
    when slope2 > before_slope and slope2 > 0 then 'bullish_acceleration' when slope2 < before_slope and slope2 < 0 then 'bearish_acceleration'
    when slope2 > before_slope and slope2 < 0 then 'bearish_deceleration' when slope2 < before_slope and slope2 > 0 then 'bullish_deceleration' else 'unknown' end as trend_change
from lastfold join cd using (symbol, rn)""")
def trend_changes(spark, d):
    from tidemark.operators.indicators import obv
    from tidemark.operators.series import compute

    drifting = staged(compute(bars(spark, d), obv()))
    out = tr.trend_changes(drifting, 20, 0.15, "obv", digits=8)
    return out.select("symbol", "pos", "date", "type", F.round("magnitude", 2).alias("magnitude"), F.round("before_slope", 6).alias("before_slope"),
                      F.round("after_slope", 6).alias("after_slope"), "value", "trend_change")


HIST = f"""rc as (select symbol, close as x, rn, least(count(*) over (partition by symbol), 200) as m, count(*) over (partition by symbol) as n from b qualify rn > n - 200 and n >= 40),
sp as (select symbol, min(x) as lo, max(x) as hi, least(50, max(m) // 5)::int as bins from rc group by symbol),
ct as (select symbol, least(floor((x - lo) / ((hi - lo) / bins))::int, bins - 1) as bin, count(*) as c from rc join sp using (symbol) group by 1, 2),
hg as (select sp.symbol, g.bin::int as bin, lo + (g.bin + 0.5) * ((hi - lo) / bins) as center, coalesce(c, 0) as c
  from sp, range(50) g(bin) left join ct on ct.symbol = sp.symbol and ct.bin = g.bin where g.bin < bins)"""


@query("price_histogram", f"with {a.BARS_RN}, {HIST} select symbol, bin, round(center, 6) as center, c as count from hg")
def price_histogram(spark, d):
    out = tr.price_histogram(tr.recent_rows(bars(spark, d), 20))
    return out.select("symbol", "bin", F.round("center", 6).alias("center"), "count")


@query("histogram_levels", f"""with recursive {BARS_REC}, {HIST}, {peaks_sql('hg', 'symbol', 'bin', 'c', 0, 3)},
t as (select *, row_number() over (partition by symbol order by c desc, bin desc) as rank from peaks join (select symbol, max(c) * 0.05 as least from hg group by 1) using (symbol) where c >= least)
select t.symbol, round(center, 6) as level, rank::int as rank from t join hg using (symbol, bin) where rank <= 3""")
def histogram_levels(spark, d):
    out = tr.histogram_levels(tr.price_histogram(tr.recent_rows(bars(spark, d), 20)))
    return out.select("symbol", F.round("level", 6).alias("level"), "rank")


@query("turning_points", f"""with {a.BARS_RN}, {HIST}, ix as (select *, row_number() over (partition by symbol order by rn) - 1 as i,
  max(x) over w as hi, min(x) over w as lo from rc window w as (partition by symbol order by rn rows between 20 preceding and 19 following))
select symbol, case when x = hi then 'max' else 'min' end as side, x from ix where i >= 20 and i < m - 20 and (x = hi or x = lo)""")
def turning_points(spark, d):
    return tr.turning_points(tr.recent_rows(bars(spark, d), 20), 20)


@query("support_resistance")
def support_resistance(spark, d):
    out = tr.support_resistance(bars(spark, d), 20)
    lists = [f"{m}_{s}s" for m in ("histogram", "peaks") for s in ("support", "resistance")]
    return out.select("symbol", "price", *[F.to_json(F.transform(c, lambda v: F.round(v, 4))).alias(c) for c in lists],
                      *[F.round(c, 4).alias(c) for c in ("strongest_level", "closest_support", "closest_resistance", "distance_to_support", "distance_to_resistance")])


@query("direction_summary", f"""with recursive {BARS_REC}, {SUMMARY}, {ema_sql(9, 21, 50)},
z as (select symbol, e9, e21, e50 from e qualify rn = max(rn) over (partition by symbol) and rn > 50),
s as (select symbol, rn, {N}, case when rn >= 10 then avg(close) {win(10)} end as y from b),
f as (select symbol, regr_slope(y, rn) filter (n - rn < 20) as s20, regr_slope(y, rn) filter (n - rn < 80) as s80 from s where y is not null group by 1)
select symbol, case when s20 > 0 then 'uptrend' else 'downtrend' end as current_trend, case when s80 > 0 then 'uptrend' else 'downtrend' end as long_term_trend,
  case when e9 > e21 and e21 > e50 then 'strong_uptrend' when e9 < e21 and e21 < e50 then 'strong_downtrend'
  when e9 > e21 and e21 < e50 then 'potential_reversal_up' when e9 < e21 and e21 > e50 then 'potential_reversal_down' else 'mixed_sideways' end as ema_trend,
  current_value, round((current_value / start_value - 1) * 100, 4) as overall_change_pct from su join z using (symbol) join f using (symbol)""")
def direction_summary(spark, d):
    out = tr.direction_summary(bars(spark, d), 20)
    return out.select("symbol", "current_trend", "long_term_trend", "ema_trend", "current_value", F.round("overall_change_pct", 4).alias("overall_change_pct"))


PHASE_IN = f"""pr as (select *, close / lag(close) {LAG} - 1 as ret, {N} from b),
px as (select symbol, max(n) as n, arg_max(close, rn) as price, max(close) as ath, stddev_samp(ret) filter (n - rn < 89) * sqrt(252) * 100 as recent_volatility,
  stddev_samp(ret) * sqrt(252) * 100 as historical_volatility, max(close) filter (n - rn = 89) as then_, regr_slope(close, rn) / avg(close) * 100 as long_term_slope from pr group by symbol),
pi as (select px.symbol, price, ath, round((price / ath - 1) * 100, 4) as drawdown_from_ath, round(recent_volatility / historical_volatility, 4) as volatility_ratio,
  round((price / then_ - 1) * 100, 4) as recent_return, round(long_term_slope, 6) as long_term_slope, round(rsi_14, 4) as rsi
  from px join rs on rs.symbol = px.symbol and rs.rn = px.n where px.n >= 135)"""


@query("market_phase", f"""with recursive {BARS_REC}, {RSI_REC}, {PHASE_IN}, lb as (select *, case
  when drawdown_from_ath < -20 and recent_return > 0 and volatility_ratio < 0.8 and rsi > 40 and rsi < 60 then 'accumulation'
  when recent_return > 10 and long_term_slope > 0 and volatility_ratio < 1.2 and rsi > 50 then 'bullish_trend'
  when drawdown_from_ath > -10 and recent_return < 5 and volatility_ratio > 1.2 and rsi > 70 then 'distribution'
  when recent_return < -10 and long_term_slope < 0 and volatility_ratio > 1 and rsi < 50 then 'bearish_trend'
  when drawdown_from_ath < -30 and recent_return < -20 and volatility_ratio > 1.5 and rsi < 30 then 'capitulation'
  when abs(recent_return) < 5 and abs(long_term_slope) < 2 and volatility_ratio < 0.8 then 'sideways' else 'indeterminate' end as current_phase from pi)
select *, (case current_phase when 'accumulation' then 0.7 when 'bullish_trend' then 0.8 when 'distribution' then 0.6 when 'bearish_trend' then 0.8
  when 'capitulation' then 0.7 when 'sideways' then 0.6 else 0.3 end)::double as confidence from lb""")
def market_phase(spark, d):
    inputs = tr.phase_inputs(bars(spark, d), 90)
    digits = {"drawdown_from_ath": 4, "volatility_ratio": 4, "recent_return": 4, "long_term_slope": 6, "rsi": 4}
    inputs = inputs.select("symbol", "price", "ath", *[F.round(c, n).alias(c) for c, n in digits.items()])
    return tr.market_phase(inputs)


# -- seasonality ---------------------------------------------------------------------------------


@query("autocorrelation", f"""with {a.BARS_RN}, l as (select symbol, count(*) as n from b group by 1),
xl as materialized (select b.symbol, lag::int as lag, rn - lag as k, close, n from b join l using (symbol), range(1, 366) g(lag) where lag <= n // 3),
p as (select xl.symbol, lag, corr(xl.close, y.close) as c, max(n) as n from xl join b y on y.symbol = xl.symbol and y.rn = k group by 1, 2)
select symbol, lag, round(c, 6) as acf, n as rows from p""")
def autocorrelation(spark, d):
    return se.autocorrelation(a.bars_daily(spark, d)).select("symbol", "lag", F.round("acf", 6).alias("acf"), "rows")


@query("return_autocorrelation", f"""with {a.BARS_RN}, q as (select symbol, rn - 1 as k, close / lag(close) {LAG} - 1 as r from b), r as (select * from q where r is not null),
l as (select symbol, count(*) as n from r group by 1),
xl as materialized (select r.symbol, lag::int as lag, k - lag as kk, r, n from r join l using (symbol), range(1, 366) g(lag) where lag < n // 3),
p as (select xl.symbol, lag, corr(xl.r, y.r) as c, max(n) as n from xl join r y on y.symbol = xl.symbol and y.k = kk group by 1, 2)
select symbol, lag, round(c, 6) as acf, n as rows from p""")
def return_autocorrelation(spark, d):
    return se.return_autocorrelation(a.bars_daily(spark, d)).select("symbol", "lag", F.round("acf", 6).alias("acf"), "rows")


RET_ACF = f"""q as (select symbol, rn - 1 as k, close / lag(close) {LAG} - 1 as r from b), r as (select * from q where r is not null),
l as (select symbol, count(*) as n from r group by 1),
xl as materialized (select r.symbol, lag::int as lag, k - lag as kk, r, n from r join l using (symbol), range(1, 366) g(lag) where lag < n // 3),
acf as materialized (select xl.symbol, lag, corr(xl.r, y.r) as c, max(n) as n from xl join r y on y.symbol = xl.symbol and y.k = kk group by 1, 2)"""


@query("seasonal_periods", f"""with recursive {BARS_REC}, {RET_ACF}, {peaks_sql('acf', 'symbol', 'lag', 'c', 0.03, 5)},
s as (select symbol, lag as period, c, abs(c) / (1.96 / sqrt(n)) as sig from peaks join (select symbol, max(n) as n from acf group by 1) using (symbol))
select symbol, period, (row_number() over (partition by symbol order by sig desc, period))::int as rank, round(c, 6) as correlation, round(sig, 6) as significance from s where sig > 1""")
def seasonal_periods(spark, d):
    out = se.seasonal_periods(bars(spark, d), height=0.03)
    return rnd(out, 6, "correlation", "significance", keep=("symbol", "period", "rank"))


LEVEL_ACF = """l as (select symbol, count(*) as n from b group by 1),
xl as materialized (select b.symbol, lag::int as lag, rn - lag as k, close, n from b join l using (symbol), range(1, 366) g(lag) where lag <= n // 3),
acf as materialized (select xl.symbol, lag, corr(xl.close, y.close) as c from xl join b y on y.symbol = xl.symbol and y.rn = k group by 1, 2)"""


@query("detect_period", f"""with recursive {BARS_REC}, {LEVEL_ACF}, {peaks_sql('acf', 'symbol', 'lag', 'c', 0.1, 5)}
select l.symbol, coalesce(min(lag), 30) as period from l left join peaks on peaks.symbol = l.symbol group by 1""")
def detect_period(spark, d):
    return se.detect_period(bars(spark, d))


CAL = f"""r as (select symbol, date, close / lag(close) {LAG} - 1 as ret from b),
cm as (select symbol, calendar, part::int as part, avg(ret) as mean_return from
  (select symbol, ret, unnest([{{'calendar': 'weekday', 'part': isodow(date) - 1}}, {{'calendar': 'month', 'part': month(date)}}, {{'calendar': 'quarter', 'part': quarter(date)}}], recursive := true) from r where ret is not null) group by 1, 2, 3)"""


@query("calendar_means", f"with {a.BARS_RN}, {CAL} select symbol, calendar, part, round(mean_return, 6) as mean_return from cm")
def calendar_means(spark, d):
    return rnd(se.calendar_means(a.bars_daily(spark, d)), 6, "mean_return", keep=("symbol", "calendar", "part"))


@query("calendar_seasonality", f"""with {a.BARS_RN}, {CAL}, x as (select symbol, calendar, arg_max(part, mean_return) as best, arg_min(part, mean_return) as worst,
  max(mean_return) - min(mean_return) as spread, stddev_samp(mean_return) as dev from cm group by 1, 2)
select symbol, calendar, best, worst, round(spread, 6) as spread, round(spread / nullif(dev, 0), 6) as significance from x where spread > case calendar when 'weekday' then 0.001 else 0.01 end""")
def calendar_seasonality(spark, d):
    out = se.calendar_patterns(se.calendar_means(a.bars_daily(spark, d)))
    return rnd(out, 6, "spread", "significance", keep=("symbol", "calendar", "best", "worst"))


@query("seasonality_flags", f"""with recursive {BARS_REC}, {RET_ACF}, {peaks_sql('acf', 'symbol', 'lag', 'c', 0.03, 5)}, {CAL.replace('r as (', 'cr as (', 1).replace('from r where', 'from cr where')},
sg as (select symbol, lag as period, abs(c) / (1.96 / sqrt(n)) as sig from peaks join (select symbol, max(n) as n from acf group by 1) using (symbol)),
per as (select symbol, count(*) as n_periods, arg_min(period, k) as strongest_period from (select *, row_number() over (partition by symbol order by sig desc, period) as k from sg where sig > 1) group by 1),
spr as (select symbol, calendar, max(mean_return) - min(mean_return) as spread from cm group by 1, 2),
pat as (select symbol, bool_or(calendar = 'weekday' and spread > 0.001) as w, bool_or(calendar = 'month' and spread > 0.01) as m, bool_or(calendar = 'quarter' and spread > 0.01) as t from spr group by 1),
every as (select symbol from b group by 1 having count(*) >= 30)
select symbol, n_periods is not null as has_significant_seasonality, coalesce(n_periods, 0) as n_periods, strongest_period, coalesce(w, false) as weekday_pattern,
  coalesce(m, false) as month_pattern, coalesce(t, false) as quarter_pattern from every left join per using (symbol) left join pat using (symbol)""")
def seasonality_flags(spark, d):
    rows = bars(spark, d)
    return se.seasonality_flags(se.seasonal_periods(rows, height=0.03), se.calendar_patterns(se.calendar_means(rows)), rows)


def decompose_sql(model: str) -> str:
    op = "-" if model == "additive" else "/"
    return f"""with {a.BARS_RN}, dn as (select *, {N} from b),
tt as (select *, case when rn > 15 and rn <= n - 15 then (sum(close) over (partition by symbol order by rn rows between 14 preceding and 14 following)
  + 0.5 * (lag(close, 15) {LAG} + lead(close, 15) {LAG})) / 30 end as t0 from dn),
ln as (select symbol, regr_slope(t0, rn) filter (rn <= 45) as hk, regr_intercept(t0, rn) filter (rn <= 45) as hc, regr_slope(t0, rn) filter (rn > n - 45) as fk,
  regr_intercept(t0, rn) filter (rn > n - 45) as fc from tt where t0 is not null group by symbol),
te as (select tt.*, coalesce(t0, case when rn <= 15 then hc + hk * rn else fc + fk * rn end) as trend from tt join ln using (symbol) where n >= 60),
ph as (select symbol, (rn - 1) % 30 as p, avg(close {op} trend) as v from te group by 1, 2),
sn as (select symbol, p, v {op} avg(v) over (partition by symbol) as seasonal from ph)
select te.symbol, date, close, round(trend, 4) as trend, round(seasonal, 4) as seasonal, round((close {op} trend) {op} seasonal, 4) as residual
from te join sn on sn.symbol = te.symbol and sn.p = (te.rn - 1) % 30"""


@query("decompose", decompose_sql("additive"))
def decompose(spark, d):
    return rnd(se.decompose(bars(spark, d), 30), 4, "trend", "seasonal", "residual", keep=("symbol", "date", "close"))


@query("decompose_multiplicative", decompose_sql("multiplicative"))
def decompose_multiplicative(spark, d):
    return rnd(se.decompose(bars(spark, d), 30, "multiplicative"), 4, "trend", "seasonal", "residual", keep=("symbol", "date", "close"))


#: A period for each symbol, laid over its bars.
PERIODS = {"AF": 11, "AO": 14, "NF": 22, "NO": 31, "RF": 38, "RO": 45}
SEASON_SQL = BARS_REC.replace("b as materialized (", "b0 as materialized (", 1) + f""",
b as materialized (select symbol, date, rn, close * 0.05 + 20000 * abs((rn % p)::double / p - 0.5) + 5000 as close
  from (select *, case symbol {' '.join(f"when '{s}' then {p}" for s, p in PERIODS.items())} else 20 end as p from b0))"""


def seasonal_bars(spark, d):
    """Bars in which each symbol has a period of its own."""
    rows = with_ordinal(bars(spark, d), out="rn")
    p = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for item in PERIODS.items() for x in item]), F.col("symbol")), F.lit(20))
    wave = F.abs((F.col("rn") % p).cast("double") / p - 0.5)
    return staged(rows.select("symbol", "date", (F.col("close") * 0.05 + 20000 * wave + 5000).alias("close")))


def decompose_auto_sql(model: str) -> str:
    op = "-" if model == "additive" else "/"
    return f"""with recursive {SEASON_SQL}, {LEVEL_ACF}, {peaks_sql('acf', 'symbol', 'lag', 'c', 0.1, 5)},
pd as (select l.symbol, coalesce(min(lag), 30)::int as period from l left join peaks on peaks.symbol = l.symbol group by 1),
dn as (select b.*, {N.replace('symbol', 'b.symbol')}, period, period // 2 as h from b join pd using (symbol)),
tt as (select x.symbol, x.rn, case when x.rn > any_value(x.h) and x.rn <= any_value(x.n) - any_value(x.h) then
    (sum(y.close) - case when any_value(x.period) % 2 = 0 then 0.5 * (min_by(y.close, y.rn) + max_by(y.close, y.rn)) else 0 end) / any_value(x.period) end as t0
  from dn x join dn y on y.symbol = x.symbol and y.rn between x.rn - x.h and x.rn + x.h group by 1, 2),
tj as (select dn.*, t0 from dn join tt using (symbol, rn)),
ln as (select symbol, regr_slope(t0, rn) filter (rn <= h + period) as hk, regr_intercept(t0, rn) filter (rn <= h + period) as hc, regr_slope(t0, rn) filter (rn > n - h - period) as fk,
  regr_intercept(t0, rn) filter (rn > n - h - period) as fc from tj where t0 is not null group by symbol),
te as (select tj.*, coalesce(t0, case when rn <= h then hc + hk * rn else fc + fk * rn end) as trend from tj join ln using (symbol) where n >= 2 * period),
ph as (select symbol, (rn - 1) % period as p, avg(close {op} trend) as v from te group by 1, 2),
sn as (select symbol, p, v {op} avg(v) over (partition by symbol) as seasonal from ph)
select te.symbol, date, round(close, 6) as close, period, round(trend, 6) as trend, round(seasonal, 6) as seasonal, round((close {op} trend) {op} seasonal, 6) as residual
from te join sn on sn.symbol = te.symbol and sn.p = (te.rn - 1) % te.period"""


@query("decompose_auto", decompose_auto_sql("additive"))
def decompose_auto(spark, d):
    """Every series with the period found in it."""
    return rnd(se.decompose(seasonal_bars(spark, d)), 6, "close", "trend", "seasonal", "residual", keep=("symbol", "date", "period"))


@query("decompose_auto_multiplicative", decompose_auto_sql("multiplicative"))
def decompose_auto_multiplicative(spark, d):
    return rnd(se.decompose(seasonal_bars(spark, d), model="multiplicative"), 6, "close", "trend", "seasonal", "residual", keep=("symbol", "date", "period"))


# -- windows that follow from the length ---------------------------------------------------------

SHARED = f"""{a.MANY_SERIES}, nn as (select *, {N} from b)"""


@query("slopes_by_length", f"""with {SHARED}, w0 as (select *, least(20, n // 4) as w, least(20, n // 4) // 2 as k from nn where n >= 8),
s as (select x.symbol, x.rn, any_value(x.n) as n, any_value(x.w) as w, any_value(x.k) as k, avg(y.close) as y from w0 x join w0 y on y.symbol = x.symbol and y.rn between x.rn - x.k + 1 and x.rn
  where x.rn >= x.k group by 1, 2),
t as (select s.*, m * w as size, m from s, (values (1), (2), (4)) v(m) where n - rn < m * w and n - (k - 1) >= m * w),
f as (select symbol, m, any_value(size) as size, regr_slope(y, rn) as sl, coalesce(corr(y, rn), 0) as r, arg_min(y, rn) as y0 from t group by 1, 2)
select symbol, size as "window", m as windows, case when sl > 0 then 'uptrend' else 'downtrend' end as direction, round(sl / y0 * 100, 6) as normalized_slope, round(r * r, 6) as r_squared from f""")
def slopes_by_length(spark, d):
    """Very many short series, each with the window its length allows, in one plan."""
    out = tr.slopes(staged(a.many_series(spark, d)), tr.Share(20, 4))
    return out.select("symbol", "window", "windows", "direction", *[F.round(c, 6).alias(c) for c in ("normalized_slope", "r_squared")])


@query("envelope_by_length", f"""with {SHARED}, w0 as (select symbol, rn, close, n, least(30, n // 4) as w from nn where n >= 8),
m as (select x.symbol, x.rn, any_value(x.n) as n, any_value(x.w) as w, avg(y.close) as m, stddev_samp(y.close) as d from w0 x join w0 y on y.symbol = x.symbol and y.rn between x.rn - x.w + 1 and x.rn
  where x.rn >= x.w group by 1, 2)
select symbol, max(n) as n, round(min(m), 5) as mean_min, round(max(m), 5) as mean_max, round(min(d), 5) as std_min, round(max(d), 5) as std_max,
  round(arg_max(m, rn) / max(m) filter (rn = w + 1) - 1, 5) as mean_change_pct from m group by symbol""")
def envelope_by_length(spark, d):
    out = st.rolling_envelope(staged(a.many_series(spark, d)), tr.Share(30, 4))
    return out.select("symbol", "n", *[F.round(c, 5).alias(c) for c in ("mean_min", "mean_max", "std_min", "std_max")], F.round("mean_change_pct", 5).alias("mean_change_pct"))


@query("turning_points_by_length", f"""with {SHARED}, w0 as (select symbol, rn - 1 as i, close as x, n, least(20, n // 5) as w from nn where n >= 10),
r as (select symbol, x, i - greatest(n - 10 * w, 0) as i, least(n, 10 * w) as m, w from w0 where i >= n - 10 * w),
e as (select p.symbol, p.i, any_value(p.x) as x, max(q.x) as hi, min(q.x) as lo from r p join r q on q.symbol = p.symbol and q.i between p.i - p.w and p.i + p.w - 1 where p.i >= p.w and p.i < p.m - p.w group by 1, 2)
select symbol, case when x = hi then 'max' else 'min' end as side, x from e where x = hi or x = lo""")
def turning_points_by_length(spark, d):
    size = tr.Share(20, 5)
    return tr.turning_points(tr.recent_rows(staged(a.many_series(spark, d)), size), size)


# -- stationarity --------------------------------------------------------------------------------


@query("kpss", f"""with {a.BARS_RN}, r as (select symbol, rn, close - avg(close) over (partition by symbol) as r, {N} from b),
c as (select *, sum(r) over (partition by symbol order by rn) as s from r),
bs as (select symbol, max(n) as n, sum(s * s) as ss, sum(r * r) as rr from c group by symbol),
xl as materialized (select symbol, lag, rn - lag as k, r from r, range(1, 366) g(lag) where lag < n),
lp as (select xl.symbol, lag, sum(xl.r * y.r) as g from xl join r y on y.symbol = xl.symbol and y.rn = k group by 1, 2),
sh as (select symbol, (coalesce(sum(lag * g / (n / 2.0)) filter (lag <= floor(pow(n, 2.0 / 9))), 0)) / (max(rr) / max(n) + coalesce(sum(g / (n / 2.0)) filter (lag <= floor(pow(n, 2.0 / 9))), 0)) as h
  from lp join bs using (symbol) group by symbol),
lg as (select symbol, least(floor(1.1447 * pow(h * h, 1.0 / 3) * pow(n, 1.0 / 3)), n - 1)::bigint as lags from sh join bs using (symbol)),
wt as (select symbol, sum(g * (1 - lag / (lags + 1.0))) filter (lag <= lags) as w from lp join lg using (symbol) group by symbol),
fin as (select symbol, bs.n, lags, (ss / (n * n)) / ((rr + 2 * coalesce(w, 0)) / n) as x from bs join lg using (symbol) join wt using (symbol))
select symbol, n, lags, round(x, 6) as statistic, round(case when x <= 0.347 then 0.1 when x <= 0.463 then 0.1 - (x - 0.347) * (0.05 / (0.463 - 0.347)) when x <= 0.574 then 0.05 - (x - 0.463) * (0.025 / (0.574 - 0.463))
  when x <= 0.739 then 0.025 - (x - 0.574) * (0.015 / (0.739 - 0.574)) else 0.01 end::double, 6) as p_value, x < 0.347 or x > 0.739 as p_clipped from fin""")
def kpss(spark, d):
    return rnd(st.kpss(bars(spark, d)), 6, "statistic", "p_value", keep=("symbol", "n", "lags", "p_clipped"))


@query("adf")
def adf(spark, d):
    return rnd(st.adf(bars(spark, d)), 6, "statistic", "p_value", "critical_1", "critical_5", "critical_10", keep=("symbol", "n", "used_lag", "is_stationary"))


@query("rolling_envelope", f"""with {a.BARS_RN}, m as (select symbol, rn, {N}, case when rn >= 30 then avg(close) {win(30)} end as m, case when rn >= 30 then stddev_samp(close) {win(30)} end as d from b)
select symbol, max(n) as n, round(min(m), 4) as mean_min, round(max(m), 4) as mean_max, round(min(d), 4) as std_min, round(max(d), 4) as std_max,
  round(arg_max(m, rn) / max(m) filter (rn = 31) - 1, 6) as mean_change_pct, round(arg_max(d, rn) / max(d) filter (rn = 31) - 1, 6) as std_change_pct from m group by symbol""")
def rolling_envelope(spark, d):
    out = st.rolling_envelope(bars(spark, d), 30)
    return out.select("symbol", "n", *[F.round(c, 4).alias(c) for c in ("mean_min", "mean_max", "std_min", "std_max")],
                      *[F.round(c, 6).alias(c) for c in ("mean_change_pct", "std_change_pct")])


@query("stationarity_consensus")
def stationarity_consensus(spark, d):
    out = st.stationarity(bars(spark, d), 30)
    return out.select("symbol", F.round("adf_p_value", 6).alias("adf_p_value"), F.round("kpss_p_value", 6).alias("kpss_p_value"), "consensus")
