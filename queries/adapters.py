"""Market data derived from the given tables: each adapter as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.series import with_ordinal


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of six symbols from ``lineitem`` trades."""
    trades = table(spark, folder, "lineitem")
    first_to_last = F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    return trades.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"), F.to_date("l_shipdate").alias("date")
    ).agg(
        F.min_by("l_extendedprice", first_to_last).alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        F.max_by("l_extendedprice", first_to_last).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


BARS_DAILY = """bars as (
  select l_returnflag || l_linestatus as symbol, cast(l_shipdate as date) as date,
    first(l_extendedprice order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as open,
    max(l_extendedprice) as high, min(l_extendedprice) as low,
    last(l_extendedprice order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as close,
    sum(l_quantity) as volume
  from lineitem group by 1, 2)"""

BARS_RN = BARS_DAILY + """,
b as (select *, row_number() over (partition by symbol order by date) as rn from bars)"""


def bars_daily_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """``bars_daily`` with deterministic damage, so that every cleaning rule has work to do."""
    b = with_ordinal(bars_daily(spark, folder), out="rn")
    hit = lambda n: F.col("rn") % n == 0
    damaged = b.select(
        "symbol", "date", "rn", "open",
        F.when(hit(53), F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(hit(53), F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(hit(41) | (F.col("rn") <= 2), None)
        .when(hit(211), F.col("close") * 10).otherwise(F.col("close")).alias("close"),
        F.when(hit(97), -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
    )
    copies = F.when(hit(67), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return damaged.withColumn("seq", F.explode(copies)).withColumn(
        "close", F.when(F.col("seq") == 1, F.col("close") + 1).otherwise(F.col("close"))
    ).drop("rn")


BARS_DIRTY = BARS_RN + """,
damaged as (
  select symbol, date, rn, open,
    case when rn % 53 = 0 then low else high end as high,
    case when rn % 53 = 0 then high else low end as low,
    case when rn % 41 = 0 or rn <= 2 then null when rn % 211 = 0 then close * 10 else close end as close,
    case when rn % 97 = 0 then -volume else volume end as volume from b),
dirty as (
  select symbol, date, open, high, low, close, volume, 0 as seq from damaged
  union all
  select symbol, date, open, high, low, close + 1, volume, 1 as seq from damaged where rn % 67 = 0),
kept as (select * from dirty where seq = 0),
d as (select *, row_number() over (partition by symbol order by date) as rn from kept)"""


def bars_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars of five symbols from ``events``."""
    e = table(spark, folder, "events")
    return e.groupBy(
        F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("ts")
    ).agg(
        F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
        F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )


BARS_HOURLY = """bars as (
  select event_type as symbol, date_trunc('hour', ts) as hour,
    arg_min(value, ts) as open, max(value) as high, min(value) as low, arg_max(value, ts) as close,
    count(*)::double as volume
  from events group by 1, 2),
b as (select symbol, hour as ts, open, high, low, close, volume,
    row_number() over (partition by symbol order by hour) as rn from bars)"""


def coin_daily(spark: SparkSession, folder: str, digits: int | None = 6) -> DataFrame:
    """Daily price, market cap and volume of five coins from ``orders``."""
    return table(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date")
    ).agg(
        (F.avg("o_totalprice") if digits is None else F.round(F.avg("o_totalprice"), digits)).alias("price"),
        F.round(F.sum("o_totalprice"), 2).alias("market_cap"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )


COIN_DAILY = """coins as (
  select o_orderpriority as symbol, cast(o_orderdate as date) as date,
    round(avg(o_totalprice), 6) as price, round(sum(o_totalprice), 2) as market_cap,
    count(*)::double as volume
  from orders group by 1, 2)"""

COIN_RN = COIN_DAILY + """,
c as (select *, row_number() over (partition by symbol order by date) as rn from coins)"""


def coin_market_total(spark: SparkSession, folder: str) -> DataFrame:
    """Total market cap, known on Mondays only."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total_market_cap"))
        .where(F.weekday("date") == 0)
    )


COIN_TOTAL = """totals as (
  select cast(o_orderdate as date) as date, round(sum(o_totalprice), 2) as total_market_cap
  from orders group by 1 having isodow(cast(o_orderdate as date)) = 1)"""


def index_daily(spark: SparkSession, folder: str, digits: int | None = 6) -> DataFrame:
    """Daily level of five regional indices."""
    o, c, n = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    return (
        o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
        .groupBy(F.concat(F.lit("^R"), "n_regionkey").alias("symbol"), F.to_date("o_orderdate").alias("date"))
        .agg((F.avg("o_totalprice") if digits is None else F.round(F.avg("o_totalprice"), digits)).alias("close"))
    )


INDEX_DAILY = """indices as (
  select '^R' || n_regionkey as symbol, cast(o_orderdate as date) as date,
    round(avg(o_totalprice), 6) as close
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  group by 1, 2)"""


def prices_long(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly mean price of all sixteen assets, long form."""
    daily = (
        bars_daily(spark, folder).select(F.lit("stock").alias("asset_class"), "symbol", "date", F.col("close").alias("v"))
        .unionByName(coin_daily(spark, folder, None).select(F.lit("crypto").alias("asset_class"), "symbol", "date", F.col("price").alias("v")))
        .unionByName(index_daily(spark, folder, None).select(F.lit("index").alias("asset_class"), "symbol", "date", F.col("close").alias("v")))
    )
    return daily.groupBy("asset_class", "symbol", F.date_trunc("week", "date").cast("date").alias("week")).agg(
        F.round(F.avg("v"), 6).alias("value")
    ).withColumnRenamed("week", "date")


_EXACT = [t.replace("round(avg(o_totalprice), 6)", "avg(o_totalprice)") for t in (COIN_DAILY, INDEX_DAILY)]
PRICES_LONG = f"""{BARS_DAILY}, {_EXACT[0]}, {_EXACT[1]},
daily as (
  select 'stock' as asset_class, symbol, date, close as v from bars
  union all select 'crypto', symbol, date, price from coins
  union all select 'index', symbol, date, close from indices),
prices as (
  select asset_class, symbol, cast(date_trunc('week', date) as date) as date, round(avg(v), 6) as value
  from daily group by 1, 2, 3)"""


def network_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Network activity per coin and day, under alias column names."""
    return table(spark, folder, "events").groupBy(
        F.col("event_type").alias("symbol"), F.to_date("ts").alias("date")
    ).agg(
        F.countDistinct("user_id").alias("active_wallets"),
        F.count(F.lit(1)).alias("tx_count"),
        F.round(F.avg("value"), 9).alias("avg_value"),
    )


NETWORK_DAILY = """network as (
  select event_type as symbol, cast(ts as date) as date, count(distinct user_id) as active_wallets,
    count(*) as tx_count, round(avg(value), 9) as avg_value
  from events group by 1, 2)"""


def many_series(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per traded part: very many short series."""
    t = table(spark, folder, "lineitem")
    return t.groupBy(F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("date")).agg(
        F.min("l_extendedprice").alias("open"), F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("close"), F.sum("l_quantity").alias("volume"))


MANY_SERIES = """bars as (select l_partkey as symbol, cast(l_shipdate as date) as date, min(l_extendedprice) as open, max(l_extendedprice) as high,
  min(l_extendedprice) as low, max(l_extendedprice) as close, sum(l_quantity) as volume from lineitem group by 1, 2),
b as (select *, row_number() over (partition by symbol order by date) as rn from bars)"""


# -- company statements --------------------------------------------------------------------------

_INCOME_LINES = [  # line, item, share of revenue or of trade value
    (2, "Cost of Goods Sold", "0.60 * gross"), (4, "Operating Income", "0.25 * rev"),
    (5, "Interest Expense", "0.02 * rev"), (6, "Net Income", "0.15 * rev"),
]
_BALANCE_LINES = [
    (2, "Total Liabilities", "0.60 * base"), (3, "Stockholders Equity", "0.40 * base"), (4, "Current Assets", "0.50 * base"),
    (5, "Current Liabilities", "0.20 * base"), (6, "Inventory", "0.10 * base"), (7, "Cash", "0.05 * base"),
    (8, "Accounts Receivable", "0.08 * base"), (9, "Long Term Debt", "0.25 * base"),
]
INCOME_CASES = [
    (1, "case when company % 2 = 1 then 'Total Revenue' else 'Revenue' end", "rev"),
    (3, "'Gross Profit'", "(rev - 0.60 * gross) * case when company % 5 = 0 then 0.80 else 1.00 end"),
    *[(i, f"'{n}'", e) for i, n, e in _INCOME_LINES],
]
BALANCE_CASES = [
    (1, "'Total Assets'", "base * case when company % 7 = 0 then 1.30 else 1.00 end"),
    *[(i, f"'{n}'", e) for i, n, e in _BALANCE_LINES],
]


def _statement_lines(facts: DataFrame, cases, period: str = "year") -> DataFrame:
    """One row per company, line and period; amounts in cents, written in four styles."""
    entries = ", ".join(
        f"named_struct('line', {i}, 'item', {item}, 'x', cast(round({e}, 2) as double))" for i, item, e in cases)
    rows = facts.select("company", F.col(period).cast("string").alias("period"), F.col(period).alias("_y"), F.explode(F.expr(f"array({entries})")).alias("e"))
    rows = rows.select("company", "period", "_y", "e.*")
    style, number = (F.col("company") + F.col("line")) % 5, F.format_number("x", 2)
    text = (
        F.when(((F.col("company") + F.col("_y")) % 6 == 0) & (F.col("line") > 1), "")
        .when(style == 1, F.concat(F.lit("$"), number)).when(style == 2, F.concat(F.lit("("), number, F.lit(")")))
        .when(style == 3, "N/A").otherwise(number))
    return rows.select("company", "line", "item", "period", text.alias("text"))


def income_raw(spark: SparkSession, folder: str) -> DataFrame:
    li, s = table(spark, folder, "lineitem"), table(spark, folder, "supplier")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    facts = li.join(s, li.l_suppkey == s.s_suppkey).groupBy(F.col("s_nationkey").alias("company"), F.year("l_shipdate").alias("year")).agg(
        F.sum(price * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(26,4)").alias("rev"), F.sum(price).cast("decimal(26,2)").alias("gross"))
    return _statement_lines(facts, INCOME_CASES)


def balance_raw(spark: SparkSession, folder: str) -> DataFrame:
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    facts = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("company"), F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(26,2)").alias("base"))
    return _statement_lines(facts, BALANCE_CASES)


def _cases_sql(facts: str, cases, out: str) -> str:
    rows = " union all ".join(
        f"select company, {i} as line, {item} as item, year, cast(round({e}, 2) as double) as x from {facts}" for i, item, e in cases)
    return f"""{out}_x as ({rows}),
{out} as (select company, line, item, year::varchar as period, case when (company + year) % 6 = 0 and line > 1 then null
  when (company + line) % 5 = 2 then -x when (company + line) % 5 = 3 then null else x end as value from {out}_x)"""


INCOME_RAW = """income_facts as (select s_nationkey as company, year(l_shipdate)::int as year,
  sum(l_extendedprice::decimal(18,2) * (1 - l_discount::decimal(4,2)))::decimal(26,4) as rev, sum(l_extendedprice::decimal(18,2))::decimal(26,2) as gross
  from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2),
""" + _cases_sql("income_facts", INCOME_CASES, "inc")
BALANCE_RAW = """balance_facts as (select c_nationkey as company, year(o_orderdate)::int as year, sum(o_totalprice::decimal(18,2))::decimal(26,2) as base
  from orders join customer on o_custkey = c_custkey group by 1, 2),
""" + _cases_sql("balance_facts", BALANCE_CASES, "bal")
