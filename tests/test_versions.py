"""Tables switch versions in one step: failures on the way, replays, two writers, and what is left behind."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import batches as ba
from tidemark.sources import sinks, versions
from tidemark.streaming import bars as sb

PRICES = "asset_id bigint, trade_date date, close_price double, volume double"
ASSETS = "symbol string, name string, asset_type string, sector string"
JAN, FEB = dt.date(2024, 1, 5), dt.date(2024, 2, 5)


def tally(df):
    return {r.action: r.records for r in df.collect()}


def prices(spark, root):
    return sorted((r.asset_id, r.trade_date, r.close_price) for r in sinks.read_star(spark, root, "stock_price").collect())


def assets(spark, root):
    return {r.symbol: (r.asset_id, r.name, r.sector) for r in sinks.read_star(spark, root, "asset").collect()}


@pytest.fixture
def loaded(spark, tmp_path):
    root = str(tmp_path)
    sinks.upsert_star(spark, root, "stock_price", spark.createDataFrame([(1, JAN, 1.0, 1.0), (1, FEB, 2.0, 1.0)], PRICES))
    sinks.load_assets(spark, root, spark.createDataFrame([("a", "A", "stock", None), ("b", "B", "stock", "tech")], ASSETS))
    return root


class Crash(RuntimeError):
    pass


def crash(*_, **__):
    raise Crash("Crash")


@pytest.mark.parametrize("where", ["commit", "written"])
def test_a_load_that_dies_leaves_the_tables_as_they_were(spark, loaded, monkeypatch, where):
    """``commit``: the rows are on disk, the manifest is not. ``written``: not even counted."""
    more = spark.createDataFrame([(1, FEB, 9.0, 1.0), (2, FEB, 3.0, 1.0)], PRICES)
    new = spark.createDataFrame([("b", "B2", "stock", None), ("c", "C", "index", None)], ASSETS)
    before = prices(spark, loaded), assets(spark, loaded)
    with monkeypatch.context() as broken:
        broken.setattr(versions, where, crash)
        with pytest.raises(Crash):
            sinks.upsert_star(spark, loaded, "stock_price", more, batch="one")
        with pytest.raises(Crash):
            sinks.load_assets(spark, loaded, new, batch="one")
    assert (prices(spark, loaded), assets(spark, loaded)) == before
    assert tally(sinks.upsert_star(spark, loaded, "stock_price", more, batch="one")) == {"updated": 1, "inserted": 1}
    assert tally(sinks.load_assets(spark, loaded, new, batch="one")) == {"updated": 1, "inserted": 1}
    assert prices(spark, loaded) == [(1, JAN, 1.0), (1, FEB, 9.0), (2, FEB, 3.0)]
    then = assets(spark, loaded)
    assert then == {"a": before[1]["a"], "b": (before[1]["b"][0], "B2", "tech"), "c": (3, "C", None)}


def test_a_write_that_dies_half_way(spark, loaded, monkeypatch):
    """Files of a part that never became one are not read, and are named as free to go."""
    before = prices(spark, loaded)
    bad = spark.createDataFrame([(3, FEB, 1.0, 1.0), (4, JAN, 0.0, 1.0)], PRICES).withColumn(
        "close_price", F.when(F.col("asset_id") == 4, F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("close_price")))
    with pytest.raises(Exception, match="broken row"):
        sinks.upsert_star(spark, loaded, "stock_price", bad)
    assert prices(spark, loaded) == before
    left = versions.write(spark.createDataFrame([(3, FEB, 1.0, 1.0, "2024-02")], PRICES + ", month string"), f"{loaded}/stock_price", "month")
    assert prices(spark, loaded) == before and f"batch={left}" in versions.unreferenced(spark, f"{loaded}/stock_price")


def test_a_batch_that_comes_again_changes_nothing(spark, loaded):
    rows = spark.createDataFrame([(1, FEB, 7.0, 1.0), (5, JAN, 5.0, 1.0)], PRICES)
    first = tally(sinks.upsert_star(spark, loaded, "stock_price", rows, batch="b"))
    later = spark.createDataFrame([(1, FEB, 8.0, 1.0)], PRICES)
    sinks.upsert_star(spark, loaded, "stock_price", later, batch="c")
    number = versions.current(spark, f"{loaded}/stock_price").number
    assert tally(sinks.upsert_star(spark, loaded, "stock_price", rows, batch="b")) == first == {"updated": 1, "inserted": 1}
    assert versions.current(spark, f"{loaded}/stock_price").number == number
    assert (1, FEB, 8.0) in prices(spark, loaded)  # the replay did not undo the later load


def test_an_empty_batch_is_recorded(spark, loaded):
    none = spark.createDataFrame([], PRICES)
    assert tally(sinks.upsert_star(spark, loaded, "stock_price", none, batch="e")) == {}
    assert versions.recorded(spark, f"{loaded}/stock_price", "e").count() == 0
    assert len(prices(spark, loaded)) == 2
    assert sinks.load_counts(spark, loaded, "stock_price", "e", ["asset_id"]).count() == 0


def test_parts_not_touched_keep_their_files(spark, loaded):
    before = versions.current(spark, f"{loaded}/stock_price").parts
    sinks.upsert_star(spark, loaded, "stock_price", spark.createDataFrame([(1, FEB, 4.0, 1.0)], PRICES))
    after = versions.current(spark, f"{loaded}/stock_price").parts
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"]
    assert len(versions.unreferenced(spark, f"{loaded}/stock_price", keep=1)) == 0  # January still lives in the first folder
    sinks.upsert_star(spark, loaded, "stock_price", spark.createDataFrame([(1, JAN, 4.0, 1.0)], PRICES))
    assert len(versions.unreferenced(spark, f"{loaded}/stock_price", keep=1)) == 1


def test_two_writers_are_noticed(spark, loaded):
    path = f"{loaded}/stock_price"
    base = versions.current(spark, path)
    versions.commit(spark, path, base, {}, [])
    with pytest.raises(versions.TwoWriters):
        versions.commit(spark, path, base, {}, [])


def test_two_commits_of_one_version_are_noticed(spark, loaded, monkeypatch):
    path = f"{loaded}/stock_price"
    base = versions.current(spark, path)
    monkeypatch.setattr(versions, "current", lambda *_: base)  # neither sees the other
    versions.commit(spark, path, base, {}, [])
    versions.commit(spark, path, base, {}, [])
    monkeypatch.undo()
    with pytest.raises(versions.TwoWriters):
        versions.current(spark, path)


def test_times_of_assets(spark, loaded):
    first = {r.symbol: r for r in sinks.read_star(spark, loaded, "asset").collect()}
    assert all(r.created_at and r.updated_at for r in first.values())
    sinks.load_assets(spark, loaded, spark.createDataFrame([("a", "A", "stock", None), ("b", "New", "stock", None)], ASSETS))
    then = {r.symbol: r for r in sinks.read_star(spark, loaded, "asset").collect()}
    assert then["a"] == first["a"]
    assert then["b"].created_at == first["b"].created_at and then["b"].updated_at > first["b"].updated_at


def test_counts_by_asset(spark, loaded):
    rows = spark.createDataFrame([(1, FEB, 7.0, 1.0), (1, JAN, 1.0, 1.0), (5, JAN, 5.0, 1.0)], PRICES)
    sinks.upsert_star(spark, loaded, "stock_price", rows, batch="b")
    got = {(r.asset_id, r.action): r.records for r in sinks.load_counts(spark, loaded, "stock_price", "b", ["asset_id"]).collect()}
    assert got == {(1, "updated"): 1, (1, "ignored"): 1, (5, "inserted"): 1}


def test_stream_replays_its_last_batch_after_a_crash(spark, tmp_path, monkeypatch):
    """The table is switched, but the stream dies before it notes the batch as done."""
    root, checkpoint, source = str(tmp_path / "star"), str(tmp_path / "checkpoint"), str(tmp_path / "rows")
    schema = spark.createDataFrame([], PRICES).schema
    spark.createDataFrame([(1, JAN, 1.0, 1.0), (1, FEB, 2.0, 1.0)], PRICES).write.parquet(source)

    def stream():
        return sb.upsert_stream(spark.readStream.schema(schema).parquet(source), root, "stock_price", checkpoint)

    real = sinks.upsert_star

    def then_die(*args, **named):
        real(*args, **named)
        raise Crash

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "upsert_star", then_die)
        with pytest.raises(Exception, match="Crash"):
            stream().awaitTermination()
    assert len(prices(spark, root)) == 2 and versions.current(spark, f"{root}/stock_price").number == 1
    stream().awaitTermination()
    assert versions.current(spark, f"{root}/stock_price").number == 1  # the same micro-batch, found done
    spark.createDataFrame([(1, FEB, 3.0, 1.0)], PRICES).write.mode("append").parquet(source)
    stream().awaitTermination()
    assert (1, FEB, 3.0) in prices(spark, root) and versions.current(spark, f"{root}/stock_price").number == 2


def test_load_batch_logs_a_failure_and_goes_on_from_there(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, JAN, 1.0, 1.0)], PRICES)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", crash)
        with pytest.raises(Crash):
            ba.load_batch(spark, str(tmp_path), {"stock_price": rows})
    ba.load_batch(spark, str(tmp_path), {"stock_price": rows})
    log = sorted((r.status, r.records_processed, r.error_message is None) for r in sinks.read_star(spark, str(tmp_path), "etl_log").collect())
    assert log == [("failed", 0, False), ("success", 1, True)]
