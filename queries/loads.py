"""Upserts, long forms and source priority: two overlapping snapshots of the bars are loaded in turn."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from queries import adapters as a
from queries.correlations import PAIRS, assets
from queries.prices import LAG, win
from tidemark.operators import correlation as co
from tidemark.operators import indicators as ind
from tidemark.operators import upsert as up
from tidemark.operators.series import compute
from tidemark.session import staged
from tidemark.sources import files, payloads, sinks

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


IDS = {"AF": 1, "AO": 2, "NF": 3, "NO": 4, "RF": 5, "RO": 6}
ID_SQL = "(case symbol " + " ".join(f"when '{s}' then {i}" for s, i in IDS.items()) + " end)::bigint"


def asset_table(spark, d):
    """The asset dimension of the bars, ids in symbol order."""
    symbols = a.table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("symbol")).distinct()
    number = F.create_map(*[F.lit(x) for item in IDS.items() for x in item])
    return symbols.select(F.try_element_at(number, F.col("symbol")).cast("long").alias("asset_id"), "symbol")


def snapshots(spark, d):
    """Target: bars before 2000. Incoming: bars from 1999 on, some changed, some closes missing."""
    bars, ids = staged(a.bars_daily(spark, d)), asset_table(spark, d)
    known, _ = up.with_asset_id(bars, ids)
    target = up.stock_price_rows(known.where(F.year("date") < 2000))
    day = F.dayofmonth("date")
    changed = known.where(F.year("date") >= 1999).withColumn("close", F.when(day == 3, F.col("close") + 1).when(day != 5, F.col("close")))
    return target, up.stock_price_rows(changed)


SNAP = f"""{a.BARS_DAILY}, ids as (select {ID_SQL} as asset_id, date as trade_date, open as open_price, high as high_price, low as low_price, close as close_price, volume from bars),
tgt as (select * from ids where year(trade_date) < 2000),
inc as (select * replace (case when day(trade_date) = 3 then close_price + 1 when day(trade_date) <> 5 then close_price end as close_price) from ids where year(trade_date) >= 1999),
mg as (select coalesce(t.asset_id, i.asset_id) as asset_id, coalesce(t.trade_date, i.trade_date) as trade_date, coalesce(i.close_price, t.close_price) as close_price,
  coalesce(i.volume, t.volume) as volume, case when i.asset_id is null then 'kept' when t.asset_id is null then 'inserted'
    when i.close_price is not null and i.close_price is distinct from t.close_price then 'updated' else 'ignored' end as action
  from tgt t full join inc i on t.asset_id = i.asset_id and t.trade_date = i.trade_date)"""


@query("upsert_prices", f"with {SNAP} select asset_id, trade_date, close_price, volume, action from mg")
def upsert_prices(spark, d):
    target, incoming = snapshots(spark, d)
    return up.merge(target, incoming, ["asset_id", "trade_date"]).select("asset_id", "trade_date", "close_price", "volume", "action")


@query("upsert_counts", f"with {SNAP} select action, count(*) as records from mg where action <> 'kept' group by 1")
def upsert_counts(spark, d):
    target, incoming = snapshots(spark, d)
    return up.counts(up.merge(target, incoming, ["asset_id", "trade_date"]))


@query("upsert_twice", f"with {SNAP} select 'ignored' as action, count(*) as records from inc")
def upsert_twice(spark, d):
    """A second load of the same rows finds nothing to do."""
    import uuid

    from tidemark.session import shared_folder

    target, incoming = snapshots(spark, d)
    root = f"{shared_folder(spark)}/tidemark-star/{uuid.uuid4().hex}"
    sinks.upsert_star(spark, root, "stock_price", target)
    sinks.upsert_star(spark, root, "stock_price", incoming)
    return sinks.upsert_star(spark, root, "stock_price", incoming)


@query("upsert_repeated_keys", f"""with {SNAP} select asset_id, trade_date, low_price, close_price - case when day(trade_date) = 3 then 1 else 0 end as close_price,
case when year(trade_date) >= 1999 then 'inserted' when day(trade_date) = 3 then 'updated' else 'ignored' end as action from ids where asset_id is not null""")
def upsert_repeated_keys(spark, d):
    """Two records per key, the last of which counts even where its values are lower."""
    bars, ids = staged(a.bars_daily(spark, d)), asset_table(spark, d)
    rows = staged(up.stock_price_rows(up.with_asset_id(bars, ids)[0]))
    last = rows.withColumn("close_price", F.when(F.dayofmonth("trade_date") == 3, F.col("close_price") - 1).otherwise(F.col("close_price"))).withColumn("seq", F.lit(2))
    first = rows.withColumns({"close_price": F.col("close_price") + 5, "low_price": F.col("low_price") + 1, "seq": F.lit(1)})
    merged = up.merge(rows.where(F.year("trade_date") < 1999), last.unionByName(first), ["asset_id", "trade_date"], "seq")
    return merged.select("asset_id", "trade_date", "low_price", "close_price", "action")


@query("upsert_coin_market", f"""with {a.COIN_DAILY}, mg as (select symbol, date as trade_date, price as price_usd, market_cap, volume as volume_24h,
case when year(date) < 1998 then 'kept' when year(date) < 2000 then case when day(date) = 7 then 'updated' else 'ignored' end else 'inserted' end as action from coins)
select symbol, trade_date, case when action in ('updated') then price_usd + 1 when action = 'inserted' and day(trade_date) = 7 then price_usd + 1 else price_usd end as price_usd, market_cap, volume_24h, action from mg""")
def upsert_coin_market(spark, d):
    coins = staged(a.coin_daily(spark, d).withColumn("asset_id", F.col("symbol")))
    target = up.coin_market_rows(coins.where(F.year("date") < 2000))
    price = F.when(F.dayofmonth("date") == 7, F.col("price") + 1).otherwise(F.col("price"))
    incoming = up.coin_market_rows(coins.where(F.year("date") >= 1998).withColumn("close", price).drop("price"))
    return up.merge(target, incoming, ["asset_id", "trade_date"]).withColumnRenamed("asset_id", "symbol")


@query("upsert_network_aliases", f"""with {a.NETWORK_DAILY} select symbol, date as trade_date, active_wallets::double as active_addresses, avg_value as avg_transaction_value,
tx_count::double as transaction_count, case when day(date) <= 15 then 'ignored' else 'inserted' end as action from network""")
def upsert_network_aliases(spark, d):
    net = staged(up.network_rows(a.network_daily(spark, d), keys=("symbol",)))
    merged = up.merge(net.where(F.dayofmonth("trade_date") <= 15), net, ["symbol", "trade_date"])
    return merged.select("symbol", "trade_date", "active_addresses", "avg_transaction_value", "transaction_count", "action")


@query("indicators_long", f"""with {a.BARS_RN}, w as (select symbol, date, case when rn >= 20 then avg(close) {win(20)} end as sma_20, (close / lag(close, 10) {LAG} - 1) * 100 as roc_10,
  case when rn >= 14 then -100 * (max(high) {win(14)} - close) / nullif(max(high) {win(14)} - min(low) {win(14)}, 0) end as williams_r_14 from b)
select symbol, date as calc_date, indicator_type, round(value, 4) as value, case indicator_type when 'sma_20' then 20.0 when 'roc_10' then 10.0 end::double as parameter1, null::double as parameter2
from (unpivot w on sma_20, roc_10, williams_r_14 into name indicator_type value value) where value is not null""")
def indicators_long(spark, d):
    wide = compute(a.bars_daily(spark, d), [ind.sma(20), ind.roc(10), ind.williams_r(14)])
    return up.indicator_rows(wide, keys=("symbol",)).withColumn("value", F.round("value", 4))


@query("correlation_upsert", f"""with {PAIRS}, m as (select symbol_1, symbol_2, round(corr(v1, v2), 6) as c from pv group by 1, 2),
k as (select {ID_SQL.replace('symbol ', 'symbol_1 ', 1)} as asset_id_1, {ID_SQL.replace('symbol ', 'symbol_2 ', 1)} as asset_id_2, c from m)
select asset_id_1, asset_id_2, date '2001-12-31' as calc_date, 'weekly' as time_window, c as correlation_value, case when asset_id_1 = 1 then case when asset_id_2 = 2 then 'updated' else 'ignored' end else 'inserted' end as action
from k where asset_id_1 is not null and asset_id_2 is not null""")
def correlation_upsert(spark, d):
    pairs = co.pearson(assets(spark, d)).withColumn("corr", F.round("corr", 6))
    pairs = pairs.withColumns({"calc_date": F.lit("2001-12-31").cast("date"), "time_window": F.lit("weekly")})
    rows = staged(up.correlation_rows(pairs, asset_table(spark, d))[0])
    old = F.when(F.col("asset_id_2") == 2, F.col("correlation_value") + 1).otherwise(F.col("correlation_value"))
    target = rows.where("asset_id_1 = 1").withColumn("correlation_value", old)
    return up.merge(target, rows, ["asset_id_1", "asset_id_2", "calc_date", "time_window"])


@query("correlation_documents", f"""with {PAIRS}, y as (select symbol_1, symbol_2, year(date) as y, round(corr(v1, v2), 6) as c from pv group by 1, 2, 3)
select symbol_1, symbol_2, make_date(y, 12, 31) as calc_date, 'yearly' as time_window, c as corr from y
union all select symbol_1, symbol_2, make_date(y, 12, 31), 'global_correlation_custom', c from y
union all select symbol_1, symbol_2, make_date(y, 12, 31), 'rolling_30d', c from y""")
def correlation_documents(spark, d):
    rows = co.complete_rows(assets(spark, d)).withColumn("y", F.year("date"))
    m = staged(co.pairwise(rows, ["y"]).withColumn("corr", F.round("corr", 6)))
    inner = m.groupBy("y", "symbol_1").agg(F.map_from_entries(F.collect_list(F.struct("symbol_2", "corr"))).alias("r"))
    matrix = inner.groupBy("y").agg(F.map_from_entries(F.collect_list(F.struct("symbol_1", "r"))).alias("matrix"))
    day = F.concat(F.col("y").cast("string"), F.lit("-12-31"))
    plain = matrix.select(F.to_json(F.struct(day.alias("calc_date"), F.lit("yearly").alias("time_window"), "matrix")).alias("payload"))
    classes = matrix.select(F.to_json(F.struct(day.alias("calc_date"), F.struct("matrix").alias("global_correlation"))).alias("payload"))
    pairs = m.groupBy(F.concat_ws("_", "symbol_1", "symbol_2").alias("pair")).agg(F.collect_list(F.struct(day.alias("date"), F.col("corr").alias("correlation"))).alias("s"))
    series = pairs.select(F.to_json(F.struct(F.create_map("pair", "s").alias("rolling_correlations"))).alias("payload"))
    return payloads.correlation_documents(plain.unionByName(classes).unionByName(series))


@query("register_assets", """with old as (select c_name as symbol, c_mktsegment as sector from customer where c_custkey % 3 <> 0), new as (select c_name as symbol, c_mktsegment as sector from customer where c_custkey % 2 = 0)
select coalesce(old.symbol, new.symbol) as symbol, coalesce(case when new.symbol is not null then case when length(new.sector) > 8 then new.sector || '*' else new.sector end end, old.sector) as sector,
  case when new.symbol is null then 'kept' when old.symbol is null then 'inserted' when length(new.sector) > 8 then 'updated' else 'ignored' end as action, true as id_is_set
from old full join new on old.symbol = new.symbol""")
def register_assets(spark, d):
    c = a.table(spark, d, "customer").select(F.col("c_custkey").alias("asset_id"), F.col("c_name").alias("symbol"), F.col("c_name").alias("name"), F.lit("stock").alias("asset_type"),
                                             F.lit(None).cast("string").alias("exchange"), F.col("c_mktsegment").alias("sector"), F.lit(None).cast("string").alias("industry"))
    sector = F.when(F.length("sector") > 8, F.concat("sector", F.lit("*"))).otherwise(F.col("sector"))
    out = up.register_assets(c.where("asset_id % 3 <> 0"), c.where("asset_id % 2 = 0").drop("asset_id").withColumn("sector", sector))
    once = F.count(F.lit(1)).over(Window.partitionBy("asset_id")) == 1
    return out.select("symbol", "sector", "action", once.alias("id_is_set"))


@query("source_priority", f"""with {a.BARS_DAILY} select symbol, date, close, case when symbol < 'N' then 'indicators' else 'clean' end as source from bars""")
def source_priority(spark, d):
    bars = a.bars_daily(spark, d).select("symbol", "date", "close")
    return files.by_priority([("cycles", bars.where("symbol < 'A'")), ("indicators", bars.where("symbol < 'N'")), ("clean", bars)])


@query("matrix_wide", f"""with {PAIRS}, m as (select symbol_1, symbol_2, round(corr(v1, v2), 6) as c from pv group by 1, 2),
f as (select symbol_1 as s, symbol_2 as t, c from m union all select symbol_2, symbol_1, c from m union all select distinct symbol, symbol, 1.0 from cr)
select s as symbol_1, """ + ", ".join(f"max(c) filter (t = '{s}') as \"{s}\"" for s in IDS) + " from f group by s")
def matrix_wide(spark, d):
    pairs = co.pearson(assets(spark, d)).withColumn("corr", F.round("corr", 6))
    return sinks.matrix_wide(pairs, list(IDS))
