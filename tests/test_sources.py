"""Payloads, pages, files and gates from literal documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as qu
from tidemark.sources import files, html, payloads, sinks


def docs(spark, *payload):
    return spark.createDataFrame([("x", json.dumps(p)) for p in payload], "symbol string, payload string")


def test_bars_payload(spark):
    day = docs(spark, {"2024-01-02": {"1. open": "1.5", "2. high": "2", "3. low": "1", "4. close": "1.7", "5. volume": "10"}})
    assert payloads.bars(day).first().asDict() == dict(symbol="x", date=dt.date(2024, 1, 2), open=1.5, high=2.0, low=1.0, close=1.7, volume=10.0, adjusted_close=None)
    minute = docs(spark, {"2024-01-02 09:30:00": {"Open": 1, "Close": "bad"}})
    row = payloads.bars(minute, intraday=True).first()
    assert row["datetime"] == dt.datetime(2024, 1, 2, 9, 30) and row.open == 1.0 and row.close is None


def test_reports_payload(spark):
    d = docs(spark, {"annualReports": [{"fiscalDateEnding": "2023-12-31", "totalRevenue": "5"}], "quarterlyReports": [{"fiscalDateEnding": "2023-09-30"}, {"fiscalDateEnding": "2023-06-30"}]}, {"annualReports": []})
    got = payloads.report_columns(payloads.reports(d), ["fiscalDateEnding", "totalRevenue"]).collect()
    assert sorted((r.reportType, r.fiscalDateEnding, r.totalRevenue) for r in got) == [
        ("annual", "2023-12-31", 5.0), ("quarterly", "2023-06-30", None), ("quarterly", "2023-09-30", None)]


def test_chart_payload_matches_by_time_last_wins(spark):
    d = docs(spark, {"prices": [[86400000, 1.0], [172800000, 2.0]], "market_caps": [[86400000, 5.0], [86400000, 6.0]], "total_volumes": [[172800000, 9.0]]})
    got = [tuple(r) for r in payloads.chart(d).orderBy("timestamp").collect()]
    assert got == [("x", dt.date(1970, 1, 2), 86400000, 1.0, 6.0, None), ("x", dt.date(1970, 1, 3), 172800000, 2.0, None, 9.0)]
    assert payloads.chart(docs(spark, {"prices": [[0, 1.0]]})).first().market_cap is None


def test_coin_payloads(spark):
    d = docs(spark, {"id": "bitcoin", "symbol": "btc", "genesis_date": "2009-01-03", "description": {"en": "coin"}, "market_data": {"current_price": {"usd": 5.5}, "price_change_percentage_24h": 1.5}}, {"symbol": "eth"})
    info = payloads.coin_info(d)
    got = {r.symbol: r for r in info.collect()}
    assert (got["BTC"].current_price, got["BTC"].price_change_24h, got["BTC"].description, got["BTC"].categories) == (5.5, 1.5, "coin", [])
    assert (got["ETH"].id, got["ETH"].name, got["ETH"].current_price) == ("", "", None)
    blocks = spark.createDataFrame([("btc", json.dumps({"hashrate": 7.0}))], "symbol string, payload string")
    net = {r.symbol: r.hashrate for r in payloads.coin_network(info, blocks).collect()}
    assert net == {"BTC": 7.0, "ETH": None}


def test_lookups(spark):
    df = spark.createDataFrame([("BTC",), ("zzz",), ("new",)], "symbol string")
    listing = spark.createDataFrame([("NEW", "b-new"), ("new", "a-new"), ("btc", "fake")], "symbol string, id string")
    assert {r.symbol: r.coin_id for r in payloads.coin_id(df, listing).collect()} == {"BTC": "bitcoin", "zzz": None, "new": "a-new"}
    assert df.select(payloads.look_up(F.lit("^GSPC"), payloads.INDEX_NAMES)).first()[0] == "S&P 500"


def test_correlation_document_layouts(spark):
    m = {"A": {"A": 1.0, "B": 0.5}, "B": {"A": 0.5, "B": 1.0}}
    d = docs(spark, {"matrix": m, "calc_date": "2024-01-02"}, {"stocks_vs_crypto": {"matrix": m}, "calc_date": "2024-01-03"},
             {"rolling_correlations": {"A_B": [{"date": "2024-01-04", "correlation": 0.25}], "A_B_C": [{"date": "2024-01-04", "correlation": 9}]}})
    got = sorted(tuple(r) for r in payloads.correlation_documents(d).collect())
    assert got == [("A", "B", dt.date(2024, 1, 2), "custom", 0.5), ("A", "B", dt.date(2024, 1, 3), "stocks_vs_crypto_custom", 0.5), ("A", "B", dt.date(2024, 1, 4), "rolling_30d", 0.25)]


def pages(spark, text):
    return spark.createDataFrame([("c", text)], "company string, html string")


def test_statement_page(spark):
    page = ('<table class="other"><tbody><tr><td>no</td></tr></tbody></table><TABLE class="x genTbl reportTbl y"><thead><tr><th> Period </th><th>2023</th><th>2022</th></tr></thead>'
            "<tbody><tr><td><b>Total&nbsp;Revenue</b></td><td>1,234.5</td><td>n/a</td></tr><tr><td>short</td><td>1</td></tr><tr><td>R&amp;D</td><td>-2</td><td> 3 </td></tr></tbody></table>")
    got = [tuple(r)[1:] for r in html.statement_rows(pages(spark, page)).orderBy("line", F.desc("period")).collect()]
    assert got == [(1, "Total Revenue", "2023", "1,234.5", 1234.5), (1, "Total Revenue", "2022", "n/a", None), (3, "R&D", "2023", "-2", -2.0), (3, "R&D", "2022", "3", 3.0)]


def test_ratio_page(spark):
    cell = '<td class="table__cell">{}</td>'
    page = ('<div class="element element--table table__section"><header class="table__title"> Valuation </header><table><tr class="table__row is-head"><th class="table__cell">x</th></tr>'
            '<tr class="table__row"><td class="table__cell fixed--column"> P/E </td>' + cell.format("1,000.5") + cell.format("-") + cell.format("N/A") + "</tr></table></div>"
            '<div class="table__section"><table><tr class="table__row"><td class="table__cell fixed--column">untitled</td></tr></table></div>')
    got = [tuple(r)[1:] for r in html.ratio_rows(pages(spark, page)).orderBy("year_offset").collect()]
    assert got == [("Valuation", "P/E", -5, 1000.5), ("Valuation", "P/E", -4, None), ("Valuation", "P/E", -3, None)]


def test_filing_page(spark):
    row = '<tr><td>{}</td><td><a href="/a/{}" id="documentsbutton">Docs</a></td><td>d</td><td> 2024-01-0{} </td></tr>'
    page = '<table class="tableFile2"><tr><th>h</th></tr><tr><td>few</td></tr>' + "".join(row.format(k, k, i) for i, k in enumerate(("10-K", "10-Q", "8-K"), 1)) + "</table>"
    got = [tuple(r)[1:] for r in html.filing_rows(pages(spark, page), limit=2).orderBy("rank").collect()]
    assert got == [(1, "10-K", "2024-01-01", "https://www.sec.gov/a/10-K"), (2, "10-Q", "2024-01-02", "https://www.sec.gov/a/10-Q")]
    assert html.filing_rows(pages(spark, "<p>none</p>")).count() == 0


def test_file_scans(spark, tmp_path):
    (tmp_path / "stocks").mkdir()
    for s in ("AAPL", "MSFT"):
        (tmp_path / "stocks" / f"{s}_daily.csv").write_text("date,open,high,low,close,volume,adjusted_close\n2024-01-02,1,2,0.5,1.5,100,1.4\n")
    (tmp_path / "stocks" / "AAPL_other.csv").write_text("date\n")
    got = files.stock_bars(spark, str(tmp_path / "stocks")).collect()
    assert sorted(r.symbol for r in got) == ["AAPL", "MSFT"] and got[0].close == 1.5
    for c in ("btc", "global"):
        (tmp_path / "coins" / c).mkdir(parents=True)
        (tmp_path / "coins" / c / f"{c}_market_data.csv").write_text("date,timestamp,price,market_cap,volume\n2024-01-02,5,1.0,2.0,3.0\n")
    assert [r.symbol for r in files.coin_series(spark, str(tmp_path / "coins"), ["global"]).collect()] == ["btc"]
    (tmp_path / "st").mkdir()
    (tmp_path / "st" / "acme_income.csv").write_text('item,2023,2022\n"Revenue, net","1,000",\nCost,5,6\n')
    (tmp_path / "st" / "beta_income.csv").write_text("item,FY1\nRevenue,7\n")
    got = sorted(tuple(r) for r in files.wide_statements(spark, str(tmp_path / "st"), "*_income.csv").where("text is not null").collect())
    assert got == [("acme", 1, "Revenue, net", "2023", "1,000"), ("acme", 2, "Cost", "2022", "6"), ("acme", 2, "Cost", "2023", "5"), ("beta", 1, "Revenue", "FY1", "7")]
    (tmp_path / "js").mkdir()
    (tmp_path / "js" / "acme_ratios.json").write_text(json.dumps({"S": {"r": {"-1": 2.5, "-2": None}}}, indent=1))
    doc = files.documents(spark, str(tmp_path / "js")).withColumnRenamed("symbol", "company")
    assert sorted((r.company, r.period, r.text) for r in payloads.ratio_document(doc).collect()) == [("acme", "-1", "2.5"), ("acme", "-2", None)]


def test_matrix_files(spark, tmp_path):
    (tmp_path / "named.csv").write_text(",A,B,C\nA,1,0.5,\nB,0.5,1,-0.25\nC,,-0.25,1\n")
    (tmp_path / "numbered.csv").write_text("x,0,1\nA,1,0.5\nB,0.5,1\n")
    read = lambda n: sorted(tuple(r)[1:] for r in files.matrix_csv(spark, str(tmp_path / n)).collect())
    assert read("named.csv") == [("A", "B", 0.5), ("B", "C", -0.25)] and read("numbered.csv") == [("A", "B", 0.5)]
    (tmp_path / "dated.csv").write_text("date,symbol,A,B\n2024-01-01,A,1,0.5\n2024-01-02,A,1,0.75\n2024-01-02,B,0.75,1\n")
    got = sorted(tuple(r) for r in files.dated_matrices(spark, str(tmp_path / "dated.csv")).collect())
    assert got == [(dt.date(2024, 1, 1), "A", "B", 0.5), (dt.date(2024, 1, 2), "A", "B", 0.75)]


def test_source_priority(spark):
    a = spark.createDataFrame([("x", 1.0)], "symbol string, close double")
    b = spark.createDataFrame([("x", 2.0, 5.0), ("y", 3.0, 5.0)], "symbol string, close double, extra double")
    got = {(r.symbol, r.close, r.source) for r in files.by_priority([("first", a), ("second", b)]).collect()}
    assert got == {("x", 1.0, "first"), ("y", 3.0, "second")}


def test_price_table(spark):
    s = spark.createDataFrame([("s", dt.date(2024, 1, 1), 1.0)], "symbol string, date date, close double")
    c = spark.createDataFrame([("c", dt.date(2024, 1, 1), None, 2.0)], "symbol string, date date, price double, close double")
    assert {(r.asset_class, r.value) for r in files.price_table(s, c, s).collect()} == {("stock", 1.0), ("crypto", 2.0), ("index", 1.0)}


def test_gates(spark):
    df = spark.createDataFrame([("few", 1.0)] * 3 + [("holes", None)] * 4 + [("holes", 1.0)] * 2 + [("fine", 1.0)] * 5, "symbol string, price double")
    assert {r.symbol: r.verdict for r in qu.coin_gate(df, ["price"]).collect()} == {"few": "too few rows", "holes": "too many nulls", "fine": "ok"}
    assert {r.verdict for r in qu.coin_gate(df, ["price", "cap"]).collect()} == {"missing columns"}
    assert {r.symbol: (r.valid, r.verdict) for r in qu.bar_gate(df, ["price"]).collect()} == {"few": (True, "ok"), "holes": (True, "nulls"), "fine": (True, "ok")}
    enough, skipped = qu.split_by_history(df, 5)
    assert enough.select("symbol").distinct().count() == 2 and skipped.first().reason == "fewer than 5 rows"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "symbol string, x double")
    for form in ("parquet", "csv"):
        sinks.write_table(df, str(tmp_path / form), form=form)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    sinks.write_documents(df.select(F.struct("symbol", "x").alias("doc")), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).select("doc.x").count() == 2
    pairs = spark.createDataFrame([("a", "b", 0.5)], "symbol_1 string, symbol_2 string, corr double")
    assert [tuple(r) for r in sinks.matrix_wide(pairs, ["a", "b"]).orderBy("symbol_1").collect()] == [("a", 1.0, 0.5), ("b", 0.5, 1.0)]
    sinks.append_log(spark, str(tmp_path / "log"), "p", "success", 3, 0.5)
    sinks.append_log(spark, str(tmp_path / "log"), "p", "failed", 0, 0.1, "boom")
    assert {r.status: r.records for r in sinks.status_summary(spark.read.parquet(str(tmp_path / "log"))).collect()} == {"success": 1, "failed": 1}


@pytest.mark.parametrize("name", ["stock_price", "etl_log"])
def test_unwritten_table_is_empty(spark, tmp_path, name):
    assert sinks.read_star(spark, str(tmp_path), name).count() == 0
