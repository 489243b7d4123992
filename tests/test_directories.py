"""Folder batches and folder loads on real file names: whole files, broken ones, replays, reports and logs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans import batches as ba
from tidemark.plans import directories as di
from tidemark.sources import files, sinks

HEAD = "date,open,high,low,close,volume,adjusted_close"


def bar_lines(n, start=dt.date(2020, 1, 1), level=100.0):
    rows = []
    for k in range(n):
        close = level + (k * 7919 % 23) / 10 + k / 50
        rows.append(f"{start + dt.timedelta(k)},{close - 0.5},{close + 1},{close - 1},{close},{1000 + k},{close}")
    return rows


@pytest.fixture
def stocks(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write = lambda name, lines: (folder / name).write_text("\n".join(lines) + ("\n" if lines else ""))
    write("AAPL_daily.csv", [HEAD, *bar_lines(260)])
    shuffled = [",".join([c[4], c[0], c[5], c[1], c[2], c[3]]) for c in (r.split(",") for r in bar_lines(230, level=50))]
    write("MSFT_daily.csv", ["close,date,volume,open,high,low", *shuffled])  # another order, a column less
    write("TORN_daily.csv", [HEAD, *bar_lines(5), "2020-02-01,1,2,3,4,5,6,7,8"])
    write("LOST_daily.csv", [HEAD, *bar_lines(5), "someday,1,2,3,4,5,6"])
    write("HEAD_daily.csv", [HEAD])
    write("NONE_daily.csv", [])
    write("WILD_daily.csv", ["a,b", "1,2"])
    write("AAPL_weekly.csv", [HEAD, *bar_lines(3)])
    return str(folder)


def test_stock_directory(spark, stocks, tmp_path):
    out = str(tmp_path / "processed")
    got = {r.series: (r.status, r.records, r.written) for r in di.process_stock_directory(spark, stocks, out).collect()}
    assert got == {"AAPL": ("processed", 260, 60), "MSFT": ("processed", 230, 30), "TORN": ("error: lines with too many cells: 1", 6, 0),
                   "LOST": ("error: rows without a date: 1", 6, 0), "HEAD": ("empty", 0, 0), "NONE": ("empty", 0, 0), "WILD": ("empty", 0, 0)}
    on_disk = {r.series: r.status for r in spark.read.json(f"{out}/processing_results").collect()}
    assert on_disk == {k: v[0] for k, v in got.items()}
    bad = spark.read.json(f"{out}/quarantine")
    assert {(r.series, r["count"]) for r in bad.groupBy("series").count().collect()} == {("TORN", 6), ("LOST", 6)}
    assert bad.where("series = 'TORN' and line is not null").first().line == "2020-02-01,1,2,3,4,5,6,7,8"
    # the same rows as the batch over the files that can be read
    one = files.stock_bars(spark, stocks, "AAPL_daily.csv")
    wanted = {r.date: r for r in ba.stock_batch(one).collect()}
    rows = {r.date: r for r in di.read_table(spark, f"{out}/processed", "csv").where("symbol = 'AAPL'").collect()}
    assert rows.keys() == wanted.keys()
    for day, row in rows.items():
        for c in ("close", "sma_20", "rsi_14", "combined_signal", "trend_label"):
            assert row[c] == pytest.approx(wanted[day][c], nan_ok=True) if row[c] is not None else wanted[day][c] is None


def test_an_empty_directory(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert di.process_stock_directory(spark, str(tmp_path / "raw"), str(tmp_path / "out")).collect() == []


def test_stock_load(spark, stocks, tmp_path):
    root, out = str(tmp_path / "star"), str(tmp_path / "processed")
    di.process_stock_directory(spark, stocks, out)
    load = lambda **named: {r.symbol: r for r in di.load_stock_directory(spark, root, out, layout=di.WRITTEN, **named).collect()}
    first = load()
    assert {s: (r.status, r.prices_inserted, r.prices_updated, r.prices_ignored) for s, r in first.items()} == {"AAPL": ("success", 60, 0, 0), "MSFT": ("success", 30, 0, 0)}
    stored = sinks.read_star(spark, root, "technical_indicator")
    assert first["AAPL"].indicators_inserted == stored.where(F.col("asset_id") == first["AAPL"].asset_id).count() > 60
    second = load()
    assert {s: (r.prices_inserted, r.prices_updated, r.prices_ignored, r.indicators_inserted, r.indicators_updated) for s, r in second.items()} == {
        "AAPL": (0, 0, 60, 0, 0), "MSFT": (0, 0, 30, 0, 0)}
    assert second["AAPL"].indicators_ignored == first["AAPL"].indicators_inserted and second["AAPL"].asset_id == first["AAPL"].asset_id
    log = sinks.read_star(spark, root, "etl_log").groupBy("process_name", "status").count().collect()
    assert {(r.process_name, r.status, r["count"]) for r in log} == {
        ("load_stock_data_AAPL", "success", 2), ("load_stock_data_MSFT", "success", 2), ("batch_load_stock_processed", "success", 2)}


def test_load_reports_what_it_cannot_load(spark, stocks, tmp_path):
    root = str(tmp_path / "star")
    got = {r.symbol: (r.status, r.message) for r in di.load_stock_directory(spark, root, stocks, pattern="*_daily.csv", register=False).collect()}
    assert got["AAPL"] == ("error", "asset not found") and got["TORN"] == ("error", "error: lines with too many cells: 1") and got["NONE"] == ("error", "empty")
    assert sinks.read_star(spark, root, "stock_price").count() == 0
    statuses = {r.status for r in sinks.read_star(spark, root, "etl_log").collect()}
    assert statuses == {"failed", "partial_success"}


def test_index_load_names_the_indices(spark, tmp_path):
    (tmp_path / "indices").mkdir()
    for name in ("gspc", "^XYZ"):
        (tmp_path / "indices" / f"{name}_processed.csv").write_text("\n".join([HEAD, *bar_lines(3)]))
    root = str(tmp_path / "star")
    got = di.load_stock_directory(spark, root, str(tmp_path / "indices"), kind="index").collect()
    assert {r.symbol: r.prices_inserted for r in got} == {"^GSPC": 3, "^XYZ": 3} and "indicators_inserted" not in got[0].asDict()
    assert {(r.symbol, r.name, r.asset_type) for r in sinks.read_star(spark, root, "asset").collect()} == {("^GSPC", "S&P 500", "index"), ("^XYZ", "^XYZ", "index")}


def test_a_load_killed_between_its_tables_is_finished_by_its_second_run(spark, stocks, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    real = sinks.upsert_star

    def prices_then_die(spark_, root_, table, *args, **named):
        if table == "technical_indicator":
            raise RuntimeError("killed")
        return real(spark_, root_, table, *args, **named)

    out = str(tmp_path / "processed")
    di.process_stock_directory(spark, stocks, out)
    load = lambda: di.load_stock_directory(spark, root, out, layout=di.WRITTEN, batch="monday")
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "upsert_star", prices_then_die)
        with pytest.raises(RuntimeError, match="killed"):
            load()
    again = {r.symbol: r for r in load().collect()}
    assert again["AAPL"].prices_inserted == 60 and again["AAPL"].indicators_inserted > 0  # counts of the whole load, prices not merged twice
    assert sinks.read_star(spark, root, "stock_price").count() == 90


@pytest.fixture
def coins(tmp_path):
    folder = tmp_path / "coins"
    for coin, n in (("btc", 260), ("eth", 220), ("bad", 4), ("data", 3)):
        (folder / coin).mkdir(parents=True)
        rows = [f"{dt.date(2020, 1, 1) + dt.timedelta(k)},{1577836800000 + k * 86400000},{10 + k % 9 + k / 40},{1000 + k},{50 + k % 7}" for k in range(n)]
        if coin == "bad":
            rows.append("1,2,3,4,5,6,7")
        (folder / coin / f"{coin}_market_data.csv").write_text("\n".join(["date,timestamp,price,market_cap,volume", *rows]))
    (folder / "sol").mkdir()
    (folder / "btc" / "btc_info.json").write_text(json.dumps({"name": "Bitcoin", "symbol": "BTC"}, indent=1))
    (folder / "sol" / "sol_info.json").write_text("{}")
    (folder / "btc" / "btc_network_data.json").write_text(json.dumps({"date": "2020-03-01", "hash_rate": 5.5, "tx_count": 12, "nested": {"a": 1}}))
    (folder / "eth" / "eth_network_data.json").write_text(json.dumps({"symbol": "ETH", "error": "none"}))
    days = [str(dt.date(2020, 1, 1) + dt.timedelta(7 * k)) for k in range(40)]
    (folder / "global_market_data.json").write_text(json.dumps({"date": days, "total_market_cap": {"usd": [5000.0 + k for k in range(40)]}}))
    return str(folder)


def test_crypto_directory_and_load(spark, coins, tmp_path):
    out, root = str(tmp_path / "out"), str(tmp_path / "star")
    got = {r.series: r for r in di.process_crypto_directory(spark, coins, out).collect()}
    flags = {s: (r.market_data, r.info, r.network_data, r.indicators, r.market_cycles) for s, r in got.items()}
    assert flags == {"BTC": (True, True, True, True, True), "ETH": (True, False, False, True, True), "BAD": (False,) * 5, "SOL": (False,) * 5}
    assert got["BAD"].status.startswith("error") and got["SOL"].status == "no market data"
    cycles = di.read_table(spark, f"{out}/market_cycles", "csv")
    assert {r.symbol: r["count"] for r in cycles.groupBy("symbol").count().collect()} == {"btc": 60, "eth": 20}
    assert cycles.where("market_dominance is null").count() == 0
    assert spark.read.json(f"{out}/network_clean").select("series").collect()[0].series == "btc"
    report = {r.symbol: r for r in di.load_crypto_directory(spark, root, coins).collect()}  # raw folder: no processed market files, but documents
    assert (report["BTC"].status, report["BTC"].market_data_inserted, report["BTC"].network_data_inserted) == ("success", 0, 1)
    report = {r.symbol: r for r in di.load_crypto_directory(spark, root, out, layout=di.WRITTEN).collect()}
    assert (report["BTC"].market_data_inserted, report["BTC"].network_data_ignored, report["ETH"].market_data_inserted) == (60, 1, 20)
    assert report["BTC"].indicators_inserted > 60
    assert {(r.symbol, r.name) for r in sinks.read_star(spark, root, "asset").collect()} >= {("BTC", "Bitcoin")}
    net = sinks.read_star(spark, root, "crypto_network_data").first()
    assert (net.trade_date, net.hashrate, net.transaction_count) == (dt.date(2020, 3, 1), 5.5, 12.0)


def test_crypto_load_takes_the_best_file(spark, tmp_path):
    folder = tmp_path / "coins"
    head = "date,price,market_cap,volume"
    for coin, kinds in (("btc", ("market_clean", "indicators", "market_cycles")), ("eth", ("market_clean",))):
        (folder / coin).mkdir(parents=True)
        for level, kind in enumerate(kinds):
            extra = ",sma_7" if kind != "market_clean" else ""
            rows = [f"2020-01-0{k},{level + k},{k},{k}" + (",1.5" if extra else "") for k in range(1, 4)]
            (folder / coin / f"{coin}_{kind}.csv").write_text("\n".join([head + extra, *rows]))
    root = str(tmp_path / "star")
    report = {r.symbol: r for r in di.load_crypto_directory(spark, root, str(folder)).collect()}
    assert (report["BTC"].market_data_inserted, report["BTC"].indicators_inserted) == (3, 3)
    assert (report["ETH"].market_data_inserted, report["ETH"].indicators_inserted) == (3, 0)
    prices = {(r.symbol, r.price_usd) for r in sinks.read_star(spark, root, "crypto_market_data").join(sinks.read_star(spark, root, "asset").select("asset_id", "symbol"), "asset_id").collect()}
    assert prices == {("BTC", 3.0), ("BTC", 4.0), ("BTC", 5.0), ("ETH", 1.0), ("ETH", 2.0), ("ETH", 3.0)}


def test_company_directory(spark, tmp_path):
    folder = tmp_path / "companies"
    for name in ("acme", "beta", "gone"):
        (folder / name).mkdir(parents=True)
    (folder / "acme" / "acme_income_statement.csv").write_text('item,2023,2022\n"Total Revenue","1,000",900\nNet Income,100,90\n')
    (folder / "acme" / "acme_balance_sheet.csv").write_text("item,2023,2022\nTotal Assets,500,400\nTotal Liabilities,300,200\nTotal Equity,200,200\n")
    (folder / "acme" / "acme_ratios.json").write_text(json.dumps({"Valuation": {"P/E": {"2023": "12.5", "2022": "-"}}}))
    (folder / "beta" / "beta_income_statement.csv").write_text("item,2023\nRevenue,7\n")
    (folder / "gone" / "gone_ratios.json").write_text("")
    out = str(tmp_path / "out")
    got = {r.company: tuple(r)[1:] for r in di.process_company_directory(spark, str(folder), out).collect()}
    assert got == {"acme": (True, True, True, True), "beta": (True, False, False, False), "gone": (False,) * 4}
    ratios = spark.read.json(f"{out}/additional_ratios").first().document.asDict(True)
    assert ratios["2023"]["Profitability_Ratios"]["ROA"] == pytest.approx(20.0) and set(ratios) == {"2022", "2023"}
    assert spark.read.json(f"{out}/ratios_clean").first().document.asDict(True) == {"Valuation": {"P/E": {"2022": None, "2023": 12.5}}}
    assert {r.item for r in spark.read.parquet(f"{out}/balance_clean").select("item").distinct().collect()} == {"total_assets", "total_liabilities", "total_equity"}
