"""Payload, page and quality-gate queries. The documents are built from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import adapters as a
from tidemark.operators import align as al
from tidemark.operators import quality as qu
from tidemark.sources import html, payloads

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def monthly(df, at, *keys):
    """Group rows into small documents: one per key and month."""
    return df.groupBy("symbol", *keys, F.date_format(at, "yyyy-MM").alias("month"))


@query("normalize_bars", f"with {a.BARS_DAILY} select symbol, date, open, high, low, close, volume from bars")
def normalize_bars(spark, d):
    bar = F.struct(*[F.col(c).cast("string").alias(f"{i}. {c}") for i, c in enumerate(("open", "high", "low", "close", "volume"), 1)])
    docs = monthly(a.bars_daily(spark, d), "date").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("date").cast("string"), bar)))).alias("payload"))
    return payloads.bars(docs).select("symbol", "date", "open", "high", "low", "close", "volume")


@query("normalize_intraday", f"with {a.BARS_HOURLY} select symbol, ts as datetime, open, high, low, close, volume from b")
def normalize_intraday(spark, d):
    bar = F.struct(*[F.col(c).cast("string").alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")])
    docs = monthly(a.bars_hourly(spark, d), "ts").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), bar)))).alias("payload"))
    return payloads.bars(docs, intraday=True).select("symbol", "datetime", "open", "high", "low", "close", "volume")


REPORT_SQL = """select s_nationkey as symbol, '{kind}' as "reportType", {end} as "fiscalDateEnding", sum(l_quantity) as "totalUnits", count(*)::double as "tradeCount"
  from lineitem join supplier on l_suppkey = s_suppkey group by 1, 3"""


@query("union_reports", REPORT_SQL.format(kind="annual", end="year(l_shipdate)::varchar") + " union all "
       + REPORT_SQL.format(kind="quarterly", end="year(l_shipdate)::varchar || '-Q' || quarter(l_shipdate)::varchar"))
def union_reports(spark, d):
    li, s = a.table(spark, d, "lineitem"), a.table(spark, d, "supplier")
    facts = li.join(s, li.l_suppkey == s.s_suppkey).groupBy(
        F.col("s_nationkey").alias("symbol"), F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q")
    ).agg(F.sum("l_quantity").alias("u"), F.count(F.lit(1)).alias("n"))
    report = lambda end, u, n: F.struct(end.alias("fiscalDateEnding"), u.cast("string").alias("totalUnits"), n.cast("string").alias("tradeCount"))
    year = F.col("y").cast("string")
    quarters = facts.groupBy("symbol").agg(F.collect_list(report(F.concat(year, F.lit("-Q"), F.col("q").cast("string")), F.col("u"), F.col("n"))).alias("quarterlyReports"))
    years = facts.groupBy("symbol", "y").agg(F.sum("u").alias("u"), F.sum("n").alias("n")).groupBy("symbol").agg(
        F.collect_list(report(year, F.col("u"), F.col("n"))).alias("annualReports"))
    docs = years.join(quarters, "symbol").select("symbol", F.to_json(F.struct("annualReports", "quarterlyReports")).alias("payload"))
    return payloads.report_columns(payloads.reports(docs), ["fiscalDateEnding", "totalUnits", "tradeCount"])


def chart_docs(spark, d):
    at = F.unix_millis(F.col("date").cast("timestamp"))
    points = lambda c: F.collect_list(F.array(at.cast("double"), F.col(c))).alias(c)
    docs = monthly(a.coin_daily(spark, d), "date").agg(points("price"), points("market_cap"), points("volume"))
    return docs.select("symbol", F.to_json(F.struct(F.col("price").alias("prices"), F.col("market_cap").alias("market_caps"), F.col("volume").alias("total_volumes"))).alias("payload"))


@query("explode_chart", f"with {a.COIN_DAILY} select symbol, date, epoch_ms(date::timestamp) as timestamp, price, market_cap, volume from coins")
def explode_chart(spark, d):
    return payloads.chart(chart_docs(spark, d))


@query("fallback_series", f"with {a.BARS_DAILY} select symbol, date, epoch(date::timestamp)::bigint as timestamp, open, high, low, close as price, volume, volume * 2 as volume_to from bars")
def fallback_series(spark, d):
    row = F.struct(F.unix_seconds(F.col("date").cast("timestamp")).alias("time"), "open", "high", "low", "close", F.col("volume").alias("volumefrom"), (F.col("volume") * 2).alias("volumeto"))
    docs = monthly(a.bars_daily(spark, d), "date").agg(F.collect_list(row).alias("Data"))
    docs = docs.select("symbol", F.to_json(F.struct(F.struct("Data").alias("Data"))).alias("payload"))
    return payloads.fallback_series(docs)


COIN_FACTS = f"""{a.COIN_DAILY}, lastday as (select symbol, arg_max(price, date) as price, arg_max(market_cap, date) as market_cap, arg_max(volume, date) as volume, count(*) as days from coins group by 1)"""


def coin_docs(spark, d):
    last = a.coin_daily(spark, d).groupBy("symbol").agg(
        *[F.max_by(c, "date").alias(c) for c in ("price", "market_cap", "volume")], F.count(F.lit(1)).alias("days"))
    usd = lambda c: F.create_map(F.lit("usd"), F.col(c))
    market = F.struct(usd("price").alias("current_price"), usd("market_cap").alias("market_cap"), usd("volume").alias("total_volume"), F.col("days").cast("double").alias("circulating_supply"))
    doc = F.struct(F.lower("symbol").alias("id"), F.lower("symbol").alias("symbol"), F.lit("Ethash").alias("hashing_algorithm"), market.alias("market_data"))
    return last.select("symbol", F.to_json(doc).alias("payload"))


@query("coin_flatten", f"""with {COIN_FACTS} select lower(symbol) as id, upper(symbol) as symbol, '' as name, 0 as n_categories, '' as description, price as current_price, market_cap,
volume as total_volume, days::double as circulating_supply, null::double as max_supply from lastday""")
def coin_flatten(spark, d):
    return payloads.coin_info(coin_docs(spark, d)).select(
        "id", "symbol", "name", F.size("categories").alias("n_categories"), "description", "current_price", "market_cap", "total_volume", "circulating_supply", "max_supply")


@query("coin_network", f"""with {COIN_FACTS} select upper(symbol) as symbol, 'Ethash' as hashing_algorithm, days::double as circulating_supply,
  case when symbol < '4' then days * 2.0::double end as transaction_count, case when symbol < '4' then price end as hashrate from lastday""")
def coin_network(spark, d):
    docs = coin_docs(spark, d)
    facts = a.coin_daily(spark, d).where("symbol < '4'").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max_by("price", "date").alias("hashrate"))
    blocks = facts.select("symbol", F.to_json(F.struct((F.col("n") * 2).alias("transaction_count"), "hashrate")).alias("payload"))
    return payloads.coin_network(payloads.coin_info(docs), blocks).select("symbol", "hashing_algorithm", "circulating_supply", "transaction_count", "hashrate")


@query("global_market", f"with {a.COIN_TOTAL} select date, total_market_cap from totals")
def global_market(spark, d):
    docs = a.coin_market_total(spark, d).groupBy(F.year("date").alias("y")).agg(F.collect_list(F.struct("date", "total_market_cap")).alias("r"))
    docs = docs.select(F.to_json(F.struct(F.col("r.date").cast("array<string>").alias("date"), F.create_map(F.lit("usd"), F.col("r.total_market_cap")).alias("total_market_cap"))).alias("payload"))
    return payloads.global_market(docs)


@query("asset_names", f"""with {a.COIN_DAILY} select distinct symbol, case when symbol = '1-URGENT' then 'urgent-coin' when symbol = '2-HIGH' then 'high-coin' end as coin_id from coins""")
def asset_names(spark, d):
    coins = a.coin_daily(spark, d).select("symbol").distinct()
    listing = coins.where(F.col("symbol") < "3").select("symbol", F.concat(F.lower(F.substring("symbol", 3, 20)), F.lit("-coin")).alias("id"))
    return payloads.coin_id(coins, listing).select("symbol", "coin_id")


@query("ratio_document", f"with {a.INCOME_RAW} select company, 'Margins' as section, item as ratio, period, round(value, 2) as value from inc")
def ratio_document(spark, d):
    from tidemark.functions.columns import amount

    cells = a.income_raw(spark, d).groupBy("company", "item").agg(F.map_from_entries(F.collect_list(F.struct("period", "text"))).alias("v"))
    docs = cells.groupBy("company").agg(F.map_from_entries(F.collect_list(F.struct("item", "v"))).alias("m"))
    docs = docs.select("company", F.to_json(F.create_map(F.lit("Margins"), F.col("m"))).alias("payload"))
    return payloads.ratio_document(docs).select("company", "section", "ratio", "period", F.round(amount("text"), 2).alias("value"))


# -- stored pages --------------------------------------------------------------------------------


def tag(name, body, css=None):
    return F.concat(F.lit(f"<{name}" + (f' class="{css}"' if css else "") + ">"), body, F.lit(f"</{name}>"))


def joined(rows):
    return F.array_join(F.array_sort(rows), "")


@query("html_statement_rows", f"""with {a.BALANCE_RAW} select company, line, item, year::varchar as period, round(x, 2) as value from bal_x""")
def html_statement_rows(spark, d):
    raw = balance_numbers(spark, d)
    lines = raw.groupBy("company", "line", "item").agg(F.array_sort(F.collect_list(F.struct("period", "text"))).alias("c"))
    cells = F.array_join(F.transform("c", lambda e: tag("td", e["text"])), "")
    head = F.array_join(F.transform("c", lambda e: tag("th", e["period"])), "")
    rows = lines.select("company", F.struct("line", tag("tr", F.concat(tag("td", F.col("item")), cells)).alias("r")).alias("row"), head.alias("head"))
    pages = rows.groupBy("company").agg(F.max("head").alias("head"), F.array_sort(F.collect_list("row")).alias("rows"))
    page = tag("html", tag("table", F.concat(tag("thead", tag("tr", F.concat(F.lit("<th>Period</th>"), F.col("head")))), tag("tbody", F.array_join("rows.r", ""))), "genTbl reportTbl"))
    return html.statement_rows(pages.select("company", page.alias("html"))).select("company", "line", "item", "period", F.round("value", 2).alias("value"))


def balance_numbers(spark, d):
    """Balance lines with plain numbers in every cell."""
    o, c = a.table(spark, d, "orders"), a.table(spark, d, "customer")
    facts = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("company"), F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(26,2)").alias("base"))
    entries = ", ".join(f"named_struct('line', {i}, 'item', {item}, 'x', cast(round({e}, 2) as double))" for i, item, e in a.BALANCE_CASES)
    return facts.select("company", F.col("year").cast("string").alias("period"), F.explode(F.expr(f"array({entries})")).alias("e")).select(
        "company", "period", "e.line", "e.item", F.format_number("e.x", 2).alias("text"))


RATIO_FACTS = """f as (select c_nationkey as company, year(o_orderdate)::int as y, count(*) as n, o_orderpriority as ratio from orders join customer on o_custkey = c_custkey group by 1, 2, 4),
k as (select *, row_number() over (partition by company, ratio order by y) - 6 as year_offset from f)"""


@query("html_ratio_rows", f"with {RATIO_FACTS} select company, 'Efficiency & more' as section, ratio, year_offset::int as year_offset, case when n % 5 = 0 then null else n * 1000.0::double end as value from k")
def html_ratio_rows(spark, d):
    o, c = a.table(spark, d, "orders"), a.table(spark, d, "customer")
    f = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("company"), F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("ratio")).agg(F.count(F.lit(1)).alias("n"))
    shown = F.when(F.col("n") % 10 == 0, "-").when(F.col("n") % 5 == 0, "N/A").otherwise(F.format_number(F.col("n") * 1000, 0))
    cells = f.groupBy("company", "ratio").agg(F.array_sort(F.collect_list(F.struct("y", shown.alias("t")))).alias("c"))
    values = F.array_join(F.transform("c", lambda e: tag("td", e["t"], "table__cell")), "")
    row = tag("tr", F.concat(tag("td", F.col("ratio"), "table__cell fixed--column"), values), "table__row")
    docs = cells.groupBy("company").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    page = tag("html", tag("div", F.concat(tag("header", F.lit("Efficiency &amp; more"), "table__title"), tag("table", F.col("rows"))), "element table__section"))
    return html.ratio_rows(docs.select("company", page.alias("html")))


@query("html_filing_rows", """with f as (select s_nationkey as company, year(l_shipdate)::varchar as y, count(*) as n from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2),
k as (select *, row_number() over (partition by company order by y) as rank from f)
select company, rank::int as rank, '10-K' as filing_type, y || '-12-31' as filing_date, 'https://www.sec.gov/doc/' || n::varchar as filing_link from k where rank <= 5""")
def html_filing_rows(spark, d):
    li, s = a.table(spark, d, "lineitem"), a.table(spark, d, "supplier")
    f = li.join(s, li.l_suppkey == s.s_suppkey).groupBy(F.col("s_nationkey").alias("company"), F.year("l_shipdate").cast("string").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    link = F.concat(F.lit('<a href="/doc/'), F.col("n").cast("string"), F.lit('" id="documentsbutton">Documents</a>'))
    row = tag("tr", F.concat(F.lit("<td>10-K</td>"), tag("td", link), F.lit("<td>Annual report</td>"), tag("td", F.concat("y", F.lit("-12-31")))))
    docs = f.groupBy("company").agg(F.array_sort(F.collect_list(F.struct("y", row.alias("r")))).alias("rows"))
    page = tag("html", tag("table", F.concat(F.lit("<tr><th>Filings</th></tr>"), F.array_join("rows.r", "")), "tableFile2"))
    return html.filing_rows(docs.select("company", page.alias("html")), limit=5)


@query("html_page_links", """with l as (select page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) as link,
unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) as name, unnest(range(1, 1 + len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>')))) as rank from pages)
select page_id, rank::int as rank, trim(replace(replace(name, '&quot;', '"'), '&amp;', '&')) as filing_type, 'https://www.sec.gov' || link as filing_link from l where rank <= 4""")
def html_page_links(spark, d):
    """The menu of every stored page, read through the filings reader after its markup is turned into that table."""
    pages = a.table(spark, d, "pages")
    row = '<tr><td>$2</td><td><a id="documentsbutton" href="$1">go</a></td><td></td><td></td></tr>'
    menu = F.regexp_replace(F.regexp_replace("html", "<li><a href=\"([^\"]*)\">([^<]*)</a></li>", row), "<ul>", "<table id=m class='wide tableFile2'><tr><th>Menu</th></tr>")
    filings = html.filing_rows(pages.select("page_id", F.replace(menu, F.lit("</ul>"), F.lit("</table>")).alias("html")), limit=4, keys=("page_id",))
    return filings.select("page_id", "rank", "filing_type", "filing_link")


# -- gates ---------------------------------------------------------------------------------------


@query("quality_gate_a", f"""with {a.BARS_DIRTY} select symbol, count(*) as rows, count(*) filter (close is null) as null_close, count(*) filter (volume is null) as null_volume,
true as valid, case when count(*) filter (close is null or volume is null) > 0 then 'nulls' else 'ok' end as verdict from dirty group by symbol""")
def quality_gate_a(spark, d):
    return qu.bar_gate(a.bars_daily_dirty(spark, d), ["close", "volume"])


@query("quality_gate_b", f"""with {a.COIN_DAILY}, h as (select symbol, date, price, case when hash_ is null then market_cap end as market_cap from (select *, case when symbol < '3' and day(date) > 10 then 1 end as hash_ from coins))
select symbol, count(*) as rows, count(*) filter (price is null) as null_price, count(*) filter (market_cap is null) as null_market_cap,
case when count(*) < 5 then 'too few rows' when count(*) filter (market_cap is null) > 0.5 * count(*) then 'too many nulls' else 'ok' end as verdict,
not (count(*) < 5 or count(*) filter (market_cap is null) > 0.5 * count(*)) as valid from h group by symbol""")
def quality_gate_b(spark, d):
    gone = (F.col("symbol") < "3") & (F.dayofmonth("date") > 10)
    rows = a.coin_daily(spark, d).withColumn("market_cap", F.when(~gone, F.col("market_cap")))
    return qu.coin_gate(rows, ["price", "market_cap"])


@query("quality_gate_c", f"""with {a.BALANCE_RAW}, t as (select company, line, period, (company + year) % 6 = 0 and line > 1 or (company + line) % 5 = 3 as gone from bal_x join (select company, line, period from bal) using (company, line) where period = year::varchar),
g as (select company, count(distinct period) + 1 as columns, count(distinct line) as rows, count(*) filter (gone) / (count(*) + count(distinct line))::double as null_share from t group by 1)
select company, columns, rows, round(null_share, 6) as null_share, case when columns < 3 then 'too few columns' when rows < 5 then 'too few rows' when null_share > 0.5 then 'too many nulls' else 'ok' end as verdict from g""")
def quality_gate_c(spark, d):
    return qu.statement_gate(a.balance_raw(spark, d)).withColumn("null_share", F.round("null_share", 6))


@query("history_gate", """with h as (select o_custkey as symbol, count(*) as rows from orders group by 1)
select symbol, rows, 'fewer than 10 rows' as reason from h where rows < 10""")
def history_gate(spark, d):
    rows = a.table(spark, d, "orders").select(F.col("o_custkey").alias("symbol"))
    return qu.split_by_history(rows, 10)[1]


@query("top_assets", """select symbol, market_cap from (select o_custkey as symbol, round(sum(o_totalprice), 2) as market_cap from orders group by 1) order by market_cap desc, symbol limit 100""")
def top_assets(spark, d):
    caps = a.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("symbol")).agg(F.round(F.sum("o_totalprice"), 2).alias("market_cap"))
    return al.top_assets(caps, 100)
