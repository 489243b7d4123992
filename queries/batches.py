"""Whole batches and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from queries import adapters as a
from queries import trends
from queries.companies import RATIOS
from queries.correlations import CLASS_PAIRS, assets
from queries.loads import asset_table, snapshots
from queries.prices import LAG, NEAR, RSI_REC, capped_sql, down_sql, up_sql, win
from tidemark.operators import cleaning as cl
from tidemark.operators import upsert as up
from tidemark.plans import batches as ba
from tidemark.session import shared_folder, staged
from tidemark.streaming import bars as sb

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


CLEAN = f"""{a.BARS_DIRTY.replace('b as (', 'b0 as (', 1).replace('from b),', 'from b0),', 1)}, {NEAR}, {capped_sql('filled', cl.OHLCV, 3.0, 0.05, 0.95)},
b as materialized (select symbol, date, open, greatest(high, low) as high, least(high, low) as low, close, case when volume < 0 then 0 else volume end as volume,
  row_number() over (partition by symbol order by date) as rn from capped)"""


@query("stock_batch", f"""with recursive {CLEAN}, {RSI_REC},
i as (select b.symbol, b.date, b.rn, b.close, avg(b.close) over w20 as sma_20, avg(b.close) over w50 as sma_50, avg(b.close) over w200 as sma_200, rsi_14,
  sum(case when true then 1 end) over (partition by b.symbol order by b.rn) as k from b join rs using (symbol, rn)
  window w20 as (partition by b.symbol order by b.rn rows 19 preceding), w50 as (partition by b.symbol order by b.rn rows 49 preceding), w200 as (partition by b.symbol order by b.rn rows 199 preceding)),
t as (select * from i where rn > 200)
select symbol, date, round(close, 4) as close, round(sma_20, 7) as sma_20, round(sma_200, 7) as sma_200, round(rsi_14, 4) as rsi_14, {up_sql('sma_50', 'sma_200')} as golden_cross,
  {down_sql('sma_50', 'sma_200')} as death_cross, {up_sql('rsi_14', '30')} as rsi_bull_cross,
  (coalesce(close > sma_20 and sma_20 > lag(sma_20) {LAG}, false))::int - (coalesce(close < sma_20 and sma_20 < lag(sma_20) {LAG}, false))::int as trend_label from t""")
def stock_batch(spark, d):
    out = ba.stock_batch(a.bars_daily_dirty(spark, d), tie=["seq"])
    return out.select("symbol", "date", *[F.round(c, n).alias(c) for c, n in (("close", 4), ("sma_20", 7), ("sma_200", 7), ("rsi_14", 4))], "golden_cross", "death_cross", "rsi_bull_cross", "trend_label")


@query("stock_batch_all")
def stock_batch_all(spark, d):
    return ba.stock_batch(a.bars_daily_dirty(spark, d), tie=["seq"], include_all=True)


CRYPTO_CLEAN = f"""{a.COIN_DAILY}, {a.COIN_TOTAL}, {capped_sql('coins', cl.COIN, 4.0, 0.0025, 0.9975)},
days as (select distinct date from capped),
near as (select days.date, arg_min(total_market_cap, abs(date_diff('day', totals.date, days.date)) * 2 - (case when totals.date > days.date then 1 else 0 end)) as total from days, totals group by 1),
x as (select symbol, date, price as close, market_cap, total, row_number() over (partition by symbol order by date) as rn from capped join near using (date)),
y as (select *, avg(close) over (partition by symbol order by rn rows 49 preceding) as s50, avg(close) over (partition by symbol order by rn rows 199 preceding) as s200 from x),
z as (select *, max(close) over (partition by symbol order by rn) as top, row_number() over (partition by symbol order by rn) as k from y where rn > 200),
e as (select *, (close / top - 1) * 100 as down, case when s50 > s200 then 1 when s50 < s200 then -1 else 0 end as trend from z),
m as (select *, case when down < -60 and trend = -1 then 1 when down < -20 and trend = 1 then 2 when down > -20 and trend = 1 then 3 when down > -10 then 4 when down < -10 and trend = -1 then 5 else 0 end as market_cycle,
  count(*) over p as np, count(*) over f as nf, max(close) over p as mp, max(close) over f as mf from e
  window p as (partition by symbol order by rn rows between 10 preceding and 1 preceding), f as (partition by symbol order by rn rows between 1 following and 10 following))"""


@query("crypto_batch", f"""with {CRYPTO_CLEAN} select symbol, date, round(close, 6) as close, round(market_cap / total * 100, 6) as market_dominance, round(down, 6) as drawdown_from_ath,
trend, (coalesce(np = 10 and nf = 10 and close > mp and close > mf, false))::int as local_top, market_cycle,
case market_cycle when 1 then 'Fondo de Mercado' when 2 then 'Recuperación' when 3 then 'Fase Alcista' when 4 then 'Euforia (Cerca de ATH)' when 5 then 'Fase Bajista' end as market_cycle_label from m""")
def crypto_batch(spark, d):
    out = ba.crypto_batch(a.coin_daily(spark, d), a.coin_market_total(spark, d))
    return out.select("symbol", "date", *[F.round(c, n).alias(c) for c, n in (("close", 6), ("market_dominance", 6), ("drawdown_from_ath", 6))], "trend", "local_top", "market_cycle", "market_cycle_label")


@query("company_batch", f"with {RATIOS} select section, ratio, count(*) as n, round(avg(value), 4) as mean from ratios where value is not null group by 1, 2")
def company_batch(spark, d):
    out = ba.company_batch(a.income_raw(spark, d), a.balance_raw(spark, d))
    return out["ratios"].groupBy("section", "ratio").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("correlation_batch")
def correlation_batch(spark, d):
    """Every row of every analysis with all its columns."""
    out = ba.correlation_batch(assets(spark, d), CLASS_PAIRS, threshold=0.15)
    parts = None
    for name, df in out.items():
        part = df.select(F.lit(name).alias("analysis"), F.to_json(F.struct(*df.columns)).alias("content"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


FIRST, LAST = "1994-01-01", "1997-12-31"
RANGE = f"""{a.PRICES_LONG}, rg as (select asset_class, symbol, date, value from prices where date between date '{FIRST}' and date '{LAST}'),
rows_ as (select 'intra_class' as analysis, asset_class as block, asset_class as cl, symbol, date, value from rg
  union all select 'cross_class_matrix', x || '_' || y, asset_class, symbol, date, value from rg join (values {", ".join(f"('{x}', '{y}')" for x, y in CLASS_PAIRS)}) v(x, y) on asset_class in (x, y)
  union all select 'matrix', '', '', symbol, date, value from rg),
un as (select analysis, block, count(distinct symbol) as k from rows_ group by 1, 2),
ok as (select analysis, block, date from (select analysis, block, date, count(*) as c from rows_ group by 1, 2, 3) join un using (analysis, block) where c = k),
cm as (select rows_.* from rows_ join ok using (analysis, block, date))"""


@query("correlation_batch_matrices", f"""with {RANGE}, m as (select x.analysis, x.block, x.symbol as symbol_1, y.symbol as symbol_2, corr(x.value, y.value) as c, count(*) as n from cm x join cm y
  on x.analysis = y.analysis and x.block = y.block and x.date = y.date and x.symbol < y.symbol and (x.analysis <> 'cross_class_matrix' or x.cl <> y.cl) group by all)
select analysis, block, symbol_1, symbol_2, round(c, 6) as corr from m where analysis <> 'cross_class_matrix' or n > 10""")
def correlation_batch_matrices(spark, d):
    """The matrices of the batch over a date range: inside the classes, between them, and over all assets."""
    out = ba.correlation_batch(assets(spark, d), CLASS_PAIRS, threshold=0.15, first=FIRST, last=LAST)
    parts = [out["intra_class"].withColumn("block", F.col("asset_class")), out["cross_class_matrix"], out["matrix"].withColumn("block", F.lit(""))]
    named = [df.select(F.lit(n).alias("analysis"), "block", "symbol_1", "symbol_2", F.round("corr", 6).alias("corr")) for n, df in zip(("intra_class", "cross_class_matrix", "matrix"), parts)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("correlation_batch_done", """select unnest(['intra_class', 'intra_class_statistics', 'cross_class_matrix', 'cross_class', 'matrix', 'statistics', 'by_period', 'clusters', 'within_clusters', 'components']) as analysis""")
def correlation_batch_done(spark, d):
    """The analyses for which three months of weeks are enough: no regimes, no rolling windows."""
    last = assets(spark, d).agg(F.max("date").alias("m")).first().m
    out = ba.correlation_batch(assets(spark, d), CLASS_PAIRS, first=str(last.replace(year=last.year - 1)))
    return spark.createDataFrame([(n,) for n in out], "analysis string")


def long_rows(name, df, **columns):
    """``analysis, symbol, key, text, value`` of the named columns (key -> digits, or None for text)."""
    cells = [F.struct(F.lit(c).alias("key"), (F.lit(None).cast("string") if digits is not None else F.col(c).cast("string")).alias("text"),
                      (F.lit(None).cast("double") if digits is None else F.round(F.col(c).cast("double"), digits)).alias("value")) for c, digits in columns.items()]
    return df.select(F.lit(name).alias("analysis"), "symbol", F.explode(F.array(*cells)).alias("c")).select("analysis", "symbol", "c.*")


def long_sql(name, sql, **columns):
    return " union all ".join(
        f"select '{name}' as analysis, symbol, '{c}' as key, {f'{c}::varchar' if digits is None else 'null::varchar'} as text, {f'round({c}, {digits})::double' if digits is not None else 'null::double'} as value from ({sql})"
        for c, digits in columns.items())


DIRECTION = {"current_trend": None, "long_term_trend": None, "ema_trend": None, "current_value": 4, "overall_change_pct": 4}
PHASE = {"current_phase": None, "confidence": 2, "recent_return": 4, "drawdown_from_ath": 4}


@query("trend_batch")
def trend_batch(spark, d):
    """Every row of every analysis with all its columns."""
    out = ba.trend_batch(a.bars_daily(spark, d))
    parts = None
    for name, df in out.items():
        part = df.select(F.lit(name).alias("analysis"), "symbol", F.to_json(F.struct(*[c for c in df.columns if c != "symbol"])).alias("content"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("trend_batch_parts", long_sql("direction", trends.SQL["direction_summary"], **DIRECTION) + " union all " + long_sql("phase", trends.SQL["market_phase"], **PHASE))
def trend_batch_parts(spark, d):
    """Direction and phase of the batch, held against SQL."""
    out = ba.trend_batch(a.bars_daily(spark, d))
    return long_rows("direction", out["direction"], **DIRECTION).unionByName(long_rows("phase", out["phase"], **PHASE))


@query("load_batch", f"""with {a.BARS_RN}, w as (select symbol, date, case when rn >= 20 then avg(close) {win(20)} end as sma_20 from b)
select 'stock_price' as "table", 'inserted' as action, count(*) as records from bars where year(date) < 2000 union all
select 'technical_indicator', 'inserted', count(*) from w where sma_20 is not null""")
def load_batch(spark, d):
    from tidemark.operators import indicators as ind
    from tidemark.operators.series import compute

    target, _ = snapshots(spark, d)
    wide = compute(a.bars_daily(spark, d), ind.sma(20))
    rows, _ = up.with_asset_id(wide, asset_table(spark, d))
    root = f"{shared_folder(spark)}/tidemark-star/{uuid.uuid4().hex}"
    return ba.load_batch(spark, root, {"stock_price": target, "technical_indicator": up.indicator_rows(rows)})


@query("landing_batch", f"""with {a.COIN_DAILY}, h as (select *, case when symbol < '3' and day(date) > 10 then null else market_cap end as mc from coins),
ok as (select symbol from h group by 1 having count(*) filter (mc is null) <= 0.5 * count(*)) select symbol, date, price, mc as market_cap, volume from h where symbol in (select symbol from ok)""")
def landing_batch(spark, d):
    gone = (F.col("symbol") < "3") & (F.dayofmonth("date") > 10)
    rows = staged(a.coin_daily(spark, d).withColumn("market_cap", F.when(~gone, F.col("market_cap"))))
    return ba.landing_batch(rows, ["price", "market_cap"])[0].select("symbol", "date", "price", "market_cap", "volume")


@query("stream_bars", """with m as (select max(ts) as last from events)
select event_type as symbol, date_trunc('hour', ts) as ts, arg_min(value, ts) as open, max(value) as high, min(value) as low, arg_max(value, ts) as close, count(*)::double as volume
from events, m group by 1, 2 having date_trunc('hour', ts) + interval 1 hour <= max(last) - interval 1 hour""")
def stream_bars(spark, d):
    """Bars that the watermark has closed."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    ticks = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    bars = sb.tick_bars(ticks, "event_type", "ts", "value")
    path = sb.fresh_folder(spark, "bars")
    sb.write_once(bars, path, sb.fresh_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path)
