"""Loads: counts, idempotence, aliases, ids; and the streaming extension."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import upsert as up
from tidemark.plans import batches as ba
from tidemark.sources import sinks
from tidemark.streaming import bars as sb

D = [dt.date(2024, 1, i) for i in range(1, 8)]
PRICES = "asset_id bigint, trade_date date, close_price double, volume double"


def tally(df):
    return {r.action: r.records for r in df.collect()}


def test_new_changed_equal_and_null(spark):
    target = spark.createDataFrame([(1, D[0], 1.0, 5.0), (1, D[1], 2.0, 5.0), (1, D[2], 3.0, 5.0), (9, D[0], 9.0, 9.0)], PRICES)
    incoming = spark.createDataFrame([(1, D[0], 1.5, None), (1, D[1], 2.0, 5.0), (1, D[2], None, None), (1, D[3], 4.0, None)], PRICES)
    merged = up.merge(target, incoming, ["asset_id", "trade_date"])
    assert tally(up.counts(merged)) == {"inserted": 1, "updated": 1, "ignored": 2}
    got = {(r.asset_id, r.trade_date): (r.close_price, r.volume) for r in merged.collect()}
    assert got == {(1, D[0]): (1.5, 5.0), (1, D[1]): (2.0, 5.0), (1, D[2]): (3.0, 5.0), (1, D[3]): (4.0, None), (9, D[0]): (9.0, 9.0)}


def test_repeated_key_takes_last_known_value(spark):
    incoming = spark.createDataFrame([(1, D[0], 1.0, 7.0, 1), (1, D[0], 2.0, None, 2)], PRICES + ", seq int")
    row = up.latest(incoming, ["asset_id", "trade_date"], "seq").first()
    assert (row.close_price, row.volume) == (2.0, 7.0)


def test_star_table_months_and_second_load(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([(1, dt.date(2024, 1, 5), 1.0, 1.0), (1, dt.date(2024, 2, 5), 2.0, 1.0)], PRICES)
    assert tally(sinks.upsert_star(spark, root, "stock_price", first)) == {"inserted": 2}
    more = spark.createDataFrame([(1, dt.date(2024, 2, 5), 2.5, 1.0), (2, dt.date(2024, 2, 5), 9.0, 1.0)], PRICES)
    assert tally(sinks.upsert_star(spark, root, "stock_price", more)) == {"updated": 1, "inserted": 1}
    assert tally(sinks.upsert_star(spark, root, "stock_price", more)) == {"ignored": 2}
    got = sorted((r.asset_id, r.trade_date, r.close_price) for r in sinks.read_star(spark, root, "stock_price").collect())
    assert got == [(1, dt.date(2024, 1, 5), 1.0), (1, dt.date(2024, 2, 5), 2.5), (2, dt.date(2024, 2, 5), 9.0)]
    assert sinks.read_star(spark, root, "stock_price").where("created_at is null").count() == 0


def test_load_batch_logs(spark, tmp_path):
    rows = spark.createDataFrame([(1, D[0], 1.0, 1.0)], PRICES)
    report = ba.load_batch(spark, str(tmp_path), {"stock_price": rows})
    assert [(r.table, r.action, r.records) for r in report.collect()] == [("stock_price", "inserted", 1)]
    log = spark.read.parquet(str(tmp_path / "etl_log")).first()
    assert (log.process_name, log.status, log.records_processed) == ("load:stock_price", "success", 1)


def test_record_shapes(spark):
    df = spark.createDataFrame([("x", D[0], 1.0, 5.0, 0.1, 7.0, "up")], "symbol string, date date, close double, volume double, macd_12_26_9 double, sma_x double, trend_label string")
    assets = spark.createDataFrame([(4, "x")], "asset_id bigint, symbol string")
    known, lost = up.with_asset_id(df, assets)
    assert up.stock_price_rows(known).columns == ["asset_id", "trade_date", "close_price", "volume"] and lost.count() == 0
    assert up.coin_market_rows(known).first().price_usd == 1.0
    long = {r.indicator_type: (r.value, r.parameter1, r.parameter2) for r in up.indicator_rows(known).collect()}
    assert long == {"macd_12_26_9": (0.1, 12.0, 26.0), "sma_x": (7.0, None, None)}
    wide = spark.createDataFrame([(1.0, "t", 1.0)], "market_cycle double, market_cycle_label string, my_return_7d_x double")
    assert up.indicator_columns(wide, crypto=True) == ["market_cycle", "my_return_7d_x"]


def test_network_aliases(spark):
    df = spark.createDataFrame([(1, D[0], 1.0, 2.0, 3.0, 4.0), (1, None, 1.0, 1.0, 1.0, 1.0)],
                               "asset_id bigint, date date, hash_rate double, hashRate double, tx_count double, transaction_count double".replace("hashRate", "active_accounts"))
    row = up.network_rows(df)
    assert row.count() == 1
    assert (row.first().hashrate, row.first().active_addresses, row.first().transaction_count, row.first().avg_transaction_fee) == (1.0, 2.0, 4.0, None)


def test_correlation_rows_report_unknown_symbols(spark):
    pairs = spark.createDataFrame([("a", "b", D[0], "w", 0.5), ("a", "z", D[0], "w", 0.1)], "symbol_1 string, symbol_2 string, calc_date date, time_window string, corr double")
    rows, lost = up.correlation_rows(pairs, spark.createDataFrame([(1, "a"), (2, "b")], "asset_id bigint, symbol string"))
    assert [tuple(r)[:2] for r in rows.collect()] == [(1, 2)] and [r.symbol for r in lost.collect()] == ["z"]


def test_register_assets(spark):
    shape = "asset_id bigint, symbol string, name string, asset_type string, exchange string, sector string, industry string"
    assets = spark.createDataFrame([(7, "a", "A", "stock", "X", "tech", None), (8, "b", "B", "stock", None, None, None), (9, "c", "C", "stock", None, None, None)], shape)
    incoming = spark.createDataFrame([("a", "A", "stock", "", None), ("b", "B2", "stock", None, None), ("n1", "N", "index", None, "new"), ("n2", "N", "index", None, None)],
                                     "symbol string, name string, asset_type string, exchange string, sector string")
    got = {r.symbol: r for r in up.register_assets(assets, incoming).collect()}
    assert {s: r.action for s, r in got.items()} == {"a": "ignored", "b": "updated", "c": "kept", "n1": "inserted", "n2": "inserted"}
    assert (got["a"].asset_id, got["a"].exchange, got["b"].name) == (7, "X", "B2")
    assert {got["n1"].asset_id, got["n2"].asset_id} == {10, 11}


def test_streaming_bars_and_upsert(spark, tmp_path):
    ticks = spark.range(240).select(F.lit("e").alias("event_type"), (F.timestamp_seconds(F.col("id") * 60)).alias("ts"), F.col("id").cast("double").alias("value"))
    ticks.write.parquet(str(tmp_path / "ticks"))
    stream = spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "ticks"))
    sb.write_once(sb.tick_bars(stream, "event_type", "ts", "value", late="30 minutes"), str(tmp_path / "bars"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "bars")).orderBy("ts").collect()
    assert [(r.open, r.close, r.high, r.low, r.volume) for r in got] == [(60.0 * i, 60.0 * i + 59, 60.0 * i + 59, 60.0 * i, 60.0) for i in range(3)]
    rows = spark.createDataFrame([(1, D[0], 1.0, 1.0), (1, D[1], 2.0, 1.0)], PRICES)
    rows.write.parquet(str(tmp_path / "rows"))
    for run in ("one", "two"):  # a replay changes nothing
        source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
        sb.upsert_stream(source, str(tmp_path / "star"), "stock_price", str(tmp_path / run)).awaitTermination()
        assert sinks.read_star(spark, str(tmp_path / "star"), "stock_price").count() == 2
