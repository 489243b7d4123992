"""Batches from folder to folder, loads from folders, and tables that survive a failed load.

The folders are written from the given tables first, in the layout Spark's writers leave.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from queries import adapters as a
from queries import batches as qb
from queries.companies import RATIOS
from queries.loads import SNAP, snapshots
from tidemark import schemas
from tidemark.plans import directories as di
from tidemark.session import shared_folder, staged
from tidemark.sources import sinks, versions
from tidemark.streaming import bars as sb

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def fresh(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/tidemark-folders/{name}-{uuid.uuid4().hex}"


# -- tables that switch versions -----------------------------------------------------------------


@query("load_after_failure", f"with {SNAP} select asset_id, trade_date, close_price, volume from mg")
def load_after_failure(spark, d):
    """A load dies after writing its rows; the next one finds the table whole, and its repetition changes nothing."""
    target, incoming = snapshots(spark, d)
    root = fresh(spark, "star")
    sinks.upsert_star(spark, root, "stock_price", target, batch="first")
    lost = incoming.withColumns({"month": F.date_format("trade_date", "yyyy-MM"), "close_price": F.lit(-1.0)})
    versions.write(lost, f"{root}/stock_price", "month")  # never committed
    for _ in range(2):
        sinks.upsert_star(spark, root, "stock_price", incoming, batch="second")
    return sinks.read_star(spark, root, "stock_price").select("asset_id", "trade_date", "close_price", "volume")


@query("load_replayed", f"with {SNAP} select action, count(*) as records from mg where action <> 'kept' group by 1")
def load_replayed(spark, d):
    """The counts of a batch that comes again are those of its first run."""
    target, incoming = snapshots(spark, d)
    root = fresh(spark, "star")
    sinks.upsert_star(spark, root, "stock_price", target)
    sinks.upsert_star(spark, root, "stock_price", incoming, batch="b")
    return sinks.upsert_star(spark, root, "stock_price", incoming, batch="b")


@query("upsert_stream", f"with {SNAP} select asset_id, trade_date, close_price, volume, case action when 'kept' then 1 else 2 end as load from mg")
def upsert_stream(spark, d):
    """A stream of changed prices, all of it played twice under one name, onto a loaded table."""
    target, incoming = snapshots(spark, d)
    root, source = fresh(spark, "star"), fresh(spark, "prices")
    sinks.upsert_star(spark, root, "stock_price", target)
    incoming.write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(incoming.schema).parquet(source)
        sb.upsert_stream(stream, root, "stock_price", fresh(spark, "checkpoint"), name="prices").awaitTermination()
    here = versions.current(spark, f"{root}/stock_price").number  # two versions: the load and one micro-batch
    touched = F.when(F.year("trade_date") >= 1999, F.lit(here)).otherwise(F.lit(1))
    return sinks.read_star(spark, root, "stock_price").select("asset_id", "trade_date", "close_price", "volume", touched.cast("int").alias("load"))


# -- stocks --------------------------------------------------------------------------------------


def stock_folder(spark, d, torn=None):
    """Bars as CSV by symbol; in the series ``torn`` some days cannot be read."""
    bars = a.bars_daily_dirty(spark, d).where("seq = 0").drop("seq")
    if torn:
        bars = bars.withColumn("date", F.when((F.col("symbol") == torn) & (F.dayofmonth("date") == 13), "the 13th").otherwise(F.col("date").cast("string")))
    folder = fresh(spark, "stocks")
    sinks.write_table(bars, f"{folder}/daily", form="csv")
    return folder


@query("stock_directory", qb.SQL["stock_batch"])
def stock_directory(spark, d):
    out = fresh(spark, "processed")
    di.process_stock_directory(spark, stock_folder(spark, d), out, layout=di.WRITTEN)
    rows = di.read_table(spark, f"{out}/processed", "csv")
    flags = [F.col(c).cast("int").alias(c) for c in ("golden_cross", "death_cross", "rsi_bull_cross", "trend_label")]
    return rows.select("symbol", "date", *[F.round(c, n).alias(c) for c, n in (("close", 4), ("sma_20", 7), ("sma_200", 7), ("rsi_14", 4))], *flags)


@query("stock_directory_summary", f"""with {a.BARS_DIRTY}, n as (select symbol as series, count(*) as records, count(*) filter (day(date) = 13) as lost from d group by 1)
select series, case when series = 'NF' and lost > 0 then 'error: rows without a date: ' || lost else 'processed' end as status, records,
  case when series = 'NF' and lost > 0 then 0 else greatest(records - 200, 0) end as written from n""")
def stock_directory_summary(spark, d):
    """One series has days that cannot be read; the others do not mind."""
    out = fresh(spark, "processed")
    di.process_stock_directory(spark, stock_folder(spark, d, torn="NF"), out, layout=di.WRITTEN)
    return spark.read.schema("series string, status string, records bigint, written bigint").json(f"{out}/processing_results")


@query("stock_directory_load", f"""with {a.BARS_DIRTY}, n as (select symbol, greatest(count(*) - 200, 0) as k from d group by 1 having count(*) > 200)
select symbol, 'success' as status, run, case when run = 1 then k else 0 end as prices_inserted, 0::bigint as prices_updated, case when run = 2 then k else 0 end as prices_ignored,
  run = 2 as indicators_known from n, (values (1), (2)) r(run)""")
def stock_directory_load(spark, d):
    """From files to the star schema, twice: the second run has nothing to do."""
    out, root = fresh(spark, "processed"), fresh(spark, "star")
    di.process_stock_directory(spark, stock_folder(spark, d), out, layout=di.WRITTEN)
    runs = None
    for run in (1, 2):
        report = di.load_stock_directory(spark, root, out, layout=di.WRITTEN)
        part = report.select("symbol", "status", F.lit(run).alias("run"), "prices_inserted", "prices_updated", "prices_ignored",
                             (F.col("indicators_ignored") > 0).alias("indicators_known"))
        runs = part if runs is None else runs.unionByName(part)
    return runs


@query("stock_directory_log", f"""with {a.BARS_DIRTY}, n as (select symbol, count(*) - 200 as k from d group by 1 having count(*) > 200)
select 'load_stock_data_' || symbol as process_name, 'success' as status, null::varchar as error_message, true as records_counted from n
union all select 'batch_load_stock_run', 'success', null, true""")
def stock_directory_log(spark, d):
    """The run log of a load: an entry per symbol and one for the batch; a symbol's records are its prices and indicators."""
    out, root = f"{fresh(spark, 'processed')}/run", fresh(spark, "star")
    di.process_stock_directory(spark, stock_folder(spark, d), out, layout=di.WRITTEN)
    report = staged(di.load_stock_directory(spark, root, out, layout=di.WRITTEN))
    entries = sinks.read_star(spark, root, "etl_log")
    wanted = report.select(F.concat(F.lit("load_stock_data_"), "symbol").alias("p"), (F.col("prices_inserted") + F.col("indicators_inserted")).alias("k"))
    symbols = report.count()
    counted = F.when(F.col("process_name").startswith("batch"), F.col("records_processed") == symbols).otherwise(F.col("records_processed") == F.col("k"))
    return entries.join(wanted, F.col("process_name") == F.col("p"), "left").select("process_name", "status", "error_message", counted.alias("records_counted"))


INDICES = {"^R0": ("gspc", "^GSPC", "S&P 500"), "^R1": ("^dji", "^DJI", "Dow Jones Industrial Average"), "^R2": ("IXIC", "^IXIC", "NASDAQ Composite"),
           "^R3": ("own", "^OWN", "^OWN"), "^R4": ("rut", "^RUT", "Russell 2000")}


@query("index_directory_load", f"""with {a.INDEX_DAILY}, m(s, symbol, name) as (values {", ".join(f"('{k}', '{v[1]}', '{v[2]}')" for k, v in INDICES.items())})
select m.symbol, name, 'index' as asset_type, count(*) as prices_inserted, min(close) as lowest from indices join m on m.s = indices.symbol group by 1, 2""")
def index_directory_load(spark, d):
    """Index files under all kinds of names: symbols get their caret, known indices their names."""
    folder, root = fresh(spark, "indices"), fresh(spark, "star")
    name = F.create_map(*[F.lit(x) for k, v in INDICES.items() for x in (k, v[0])])
    rows = a.index_daily(spark, d).withColumn("symbol", F.try_element_at(name, F.col("symbol")))
    sinks.write_table(rows, f"{folder}/processed", form="csv")
    report = di.load_stock_directory(spark, root, folder, kind="index", layout=di.WRITTEN).select("symbol", "asset_id", "prices_inserted")
    named = report.join(sinks.read_star(spark, root, "asset").select("asset_id", "name", "asset_type"), "asset_id")
    lowest = sinks.read_star(spark, root, "stock_price").groupBy("asset_id").agg(F.min("close_price").alias("lowest"))
    return named.join(lowest, "asset_id").drop("asset_id")


# -- coins ---------------------------------------------------------------------------------------


def coin_folder(spark, d):
    """Coins as CSV by symbol, the total market cap as a document, a description of every second coin and network data of one."""
    coins = staged(a.coin_daily(spark, d))
    folder = fresh(spark, "coins")
    sinks.write_table(coins.withColumn("timestamp", F.unix_millis(F.col("date").cast("timestamp"))), f"{folder}/market_data", form="csv")
    total = a.coin_market_total(spark, d).orderBy("date")
    lists = total.agg(F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("d"), F.col("total_market_cap").alias("v")))).alias("l"))  # one entry per week
    doc = lists.select(F.to_json(F.struct(F.col("l.d").alias("date"), F.struct(F.col("l.v").alias("usd")).alias("total_market_cap"))).alias("value"))
    doc.coalesce(1).write.text(f"{folder}/global_market_data")
    names = coins.select("symbol").distinct()
    facts = F.to_json(F.struct(F.concat(F.lit("Coin "), "symbol").alias("name"), F.col("symbol").alias("id")))
    sinks.write_documents(names.where("substr(symbol, 1, 1) in ('1', '3', '5')").select(F.col("symbol").alias("series"), facts.alias("payload")), f"{folder}/info")
    net = F.to_json(F.struct(F.lit("1999-05-06").alias("date"), F.lit(7.5).alias("hash_rate"), F.lit(12).alias("tx_count")))
    poor = F.to_json(F.struct(F.col("symbol"), F.lit("none").alias("error")))
    sinks.write_documents(names.select(F.col("symbol").alias("series"), F.when(F.col("symbol").startswith("2"), net).otherwise(poor).alias("payload")), f"{folder}/network_data")
    return folder


@query("crypto_directory", qb.SQL["crypto_batch"])
def crypto_directory(spark, d):
    out = fresh(spark, "processed")
    di.process_crypto_directory(spark, coin_folder(spark, d), out, layout=di.WRITTEN)
    rows = di.read_table(spark, f"{out}/market_cycles", "csv")
    return rows.select("symbol", "date", *[F.round(c, n).alias(c) for c, n in (("close", 6), ("market_dominance", 6), ("drawdown_from_ath", 6))],
                       *[F.col(c).cast("int").alias(c) for c in ("trend", "local_top", "market_cycle")], "market_cycle_label")


@query("crypto_directory_summary", f"""with {a.COIN_DAILY} select upper(symbol) as series, 'processed' as status, count(*) as records, true as market_data, substr(symbol, 1, 1) in ('1', '3', '5') as info,
  symbol like '2%' as network_data, true as indicators, true as market_cycles from coins group by symbol""")
def crypto_directory_summary(spark, d):
    out = fresh(spark, "processed")
    di.process_crypto_directory(spark, coin_folder(spark, d), out, layout=di.WRITTEN)
    shape = "series string, status string, records bigint, market_data boolean, info boolean, network_data boolean, indicators boolean, market_cycles boolean"
    return spark.read.schema(shape).json(f"{out}/processing_results")


@query("crypto_directory_load", f"""with {a.COIN_DAILY}, n as (select upper(symbol) as symbol, greatest(count(*) - 200, 0) as k, count(*) as m from coins group by 1)
select symbol, case when substr(symbol, 1, 1) in ('1', '3', '5') then 'Coin ' || symbol else symbol end as name, 'success' as status,
  case when k > 0 then k else m end as market_data_inserted, case when symbol like '2%' then 1 else 0 end::bigint as network_data_inserted, k > 0 as has_indicators from n""")
def crypto_directory_load(spark, d):
    """Coin folders to the star schema: the best market file, names from the descriptions, network records."""
    out, root = fresh(spark, "processed"), fresh(spark, "star")
    di.process_crypto_directory(spark, coin_folder(spark, d), out, layout=di.WRITTEN)
    report = di.load_crypto_directory(spark, root, out, layout=di.WRITTEN)
    names = sinks.read_star(spark, root, "asset").select("symbol", "name")
    return report.join(names, "symbol").select("symbol", "name", "status", "market_data_inserted", "network_data_inserted", (F.col("indicators_inserted") > 0).alias("has_indicators"))


# -- companies -----------------------------------------------------------------------------------


def company_folder(spark, d):
    """Statements as wide CSV by company, and a ratio document each; every third company lacks its balance sheet."""
    folder = fresh(spark, "companies")
    for kind, raw in (("income_statement", a.income_raw(spark, d)), ("balance_sheet", a.balance_raw(spark, d).where("company % 3 <> 2"))):
        raw = staged(raw)
        years = sorted(r[0] for r in raw.select("period").distinct().collect())  # calendar years
        wide = raw.groupBy("company", "line", "item").pivot("period", years).agg(F.first("text")).repartition("company").sortWithinPartitions("company", "line")
        wide.drop("line").write.partitionBy("company").option("header", True).csv(f"{folder}/{kind}")
    ids = a.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("series"), F.col("n_regionkey").alias("r"))
    text = F.when(F.col("r") == 0, "-").otherwise(F.concat(F.col("series"), F.lit(".5%")))
    doc = F.to_json(F.create_map(F.lit("Valuation"), F.create_map(F.lit("P/E"), F.create_map(F.lit("2001"), text))))
    sinks.write_documents(ids.select("series", doc.alias("payload")), f"{folder}/ratios")
    return folder




@query("company_directory", f"with {RATIOS} select section, ratio, count(*) as n, round(avg(value), 4) as mean from ratios where value is not null and company % 3 <> 2 group by 1, 2")
def company_directory(spark, d):
    out = fresh(spark, "processed")
    di.process_company_directory(spark, company_folder(spark, d), out, layout=di.WRITTEN)
    docs = spark.read.schema("company string, document map<string,map<string,map<string,double>>>").json(f"{out}/additional_ratios")
    rows = docs.select("company", F.explode("document").alias("period", "s")).select("period", F.explode("s").alias("section", "r")).select(
        "section", F.explode("r").alias("ratio", "value"))
    return rows.groupBy("section", "ratio").agg(F.count("value").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("company_directory_summary", f"""with {a.INCOME_RAW}, {a.BALANCE_RAW}, i as (select distinct company from income_facts), b as (select distinct company from balance_facts where company % 3 <> 2)
select n_nationkey::varchar as company, i.company is not null as income_statement, b.company is not null as balance_sheet, true as ratios,
  i.company is not null and b.company is not null as additional_ratios from nation left join i on i.company = n_nationkey left join b on b.company = n_nationkey""")
def company_directory_summary(spark, d):
    out = fresh(spark, "processed")
    di.process_company_directory(spark, company_folder(spark, d), out, layout=di.WRITTEN)
    return spark.read.schema("company string, income_statement boolean, balance_sheet boolean, ratios boolean, additional_ratios boolean").json(f"{out}/processing_results")


@query("company_directory_ratios", """select n_nationkey::varchar as company, 'Valuation' as section, 'P/E' as ratio, '2001' as period, n_nationkey + 0.5::double as value from nation where n_regionkey <> 0""")
def company_directory_ratios(spark, d):
    """The ratio documents as cleaned and written: nested maps, read back."""
    out = fresh(spark, "processed")
    di.process_company_directory(spark, company_folder(spark, d), out, layout=di.WRITTEN)
    docs = spark.read.schema(f"company string, document {schemas.RATIO_PAYLOAD}").json(f"{out}/ratios_clean")
    rows = docs.select("company", F.explode("document").alias("section", "r")).select("company", "section", F.explode("r").alias("ratio", "v"))
    return rows.select("company", "section", "ratio", F.explode("v").alias("period", "text")).select(
        "company", "section", "ratio", "period", F.col("text").cast("double").alias("value"))
