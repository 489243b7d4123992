"""Batches from folder to folder, and from folder to star schema: one plan for all files, one status per series.

A series that cannot be processed does not stop the others: its rows go to ``quarantine`` with the reason, and the
summary says what became of it. What a batch writes is read back for its next step, so nothing is computed twice.

Two layouts are read. ``named``: files named after their series and kind (``AAPL_daily.csv``, ``btc/btc_info.json``). ``written``:
as Spark's writers and these batches leave them, a folder per kind with one partition folder per series, documents
as JSON lines of ``series`` and ``payload``; so what one batch wrote is another one's input.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import stock_symbol
from tidemark.operators import cleaning as cl
from tidemark.operators import company as co
from tidemark.operators import upsert as up
from tidemark.plans import batches as ba
from tidemark.session import staged
from tidemark.sources import files, payloads, sinks

#: Folders that are never coins or companies.
NOT_SERIES = (".git", "data", "__pycache__")
STOCK_CELLS = ("open", "high", "low", "close", "volume", "adjusted_close")
COIN_CELLS = ("timestamp", "price", "market_cap", "volume")
INDICATOR_MARKS = ("sma_", "ema_", "rsi_", "macd_")
FILE = "file"
NAMED, WRITTEN = "named", "written"


def _place(folder: str, kind: str, layout: str, pattern: str) -> tuple[str, str]:
    """(folder, file pattern) of a kind of files."""
    if layout not in (NAMED, WRITTEN):
        raise ValueError(f"layout must be {NAMED} or {WRITTEN}, not {layout}")
    return (f"{folder}/{kind}", "part-*") if layout == WRITTEN else (folder, pattern)


def _name(layout: str, of_file: Column) -> Column:
    return files.partition_value(FILE) if layout == WRITTEN else of_file


def _sorted_out(spark: SparkSession, folder: str, pattern: str, cells: Sequence[str] | None, series: Column, output: str | None) -> tuple[DataFrame, DataFrame]:
    """(rows of the series fit to be processed, status of all); the others' rows go to ``quarantine``."""
    found = files.listing(spark, folder, pattern).withColumn("series", series)
    raw = files.csv_rows(spark, folder, pattern).withColumn("series", series)
    rows = staged(files.typed(raw, cells))
    status = staged(files.series_status(found, rows))
    if output is not None:
        bad = rows.join(status.where("status like 'error%'").select("series", F.col("status").alias("reason")), "series")
        sinks.write_documents(bad, f"{output}/quarantine")
    good = rows.join(status.where(F.col("status") == files.PROCESSED).select("series"), "series", "left_semi")
    return good.drop("file", "line").withColumnRenamed("series", "symbol"), status


# -- processing ----------------------------------------------------------------------------------


def process_stock_directory(spark: SparkSession, input_dir: str, output_dir: str, indicators: bool = True, signals: bool = True, pattern: str = "*_daily.csv",
                            layout: str = NAMED, form: str = "csv", **options) -> DataFrame:
    """Bar files to ``processed`` (by symbol), ``quarantine`` and ``processing_results``; gives the latter: series, status, records, written."""
    good, status = _sorted_out(spark, *_place(input_dir, "daily", layout, pattern), STOCK_CELLS, _name(layout, files.file_symbol(FILE)), output_dir)
    sinks.write_table(ba.stock_batch(good, indicators=indicators, signals=signals, **options), f"{output_dir}/processed", form=form)
    done = read_table(spark, f"{output_dir}/processed", form).groupBy(F.col("symbol").cast("string").alias("series")).agg(F.count(F.lit(1)).alias("written"))
    return _report(status.join(done, "series", "left").withColumn("written", F.coalesce("written", F.lit(0))), output_dir)


def process_crypto_directory(spark: SparkSession, input_dir: str, output_dir: str, indicators: bool = True, cycles: bool = True, layout: str = NAMED,
                             form: str = "csv", **options) -> DataFrame:
    """Coin folders to ``market_clean``, ``indicators``, ``market_cycles``, ``info_clean``, ``network_clean`` and the global document.

    The summary has a row per coin: what of market_data, info, network_data, indicators and market_cycles there is.
    """
    coin = _name(layout, F.lower(files.parent_name(FILE)))
    good, status = _sorted_out(spark, *_place(input_dir, "market_data", layout, "*_market_data.csv"), COIN_CELLS, coin, output_dir)
    status = status.where(~F.col("series").isin(*NOT_SERIES))
    good = good.where(~F.col("symbol").isin(*NOT_SERIES))
    total = _global_market(spark, input_dir, output_dir, layout)
    sinks.write_table(cl.clean_crypto_data(good, tie=options.pop("tie", ("price",))), f"{output_dir}/market_clean", form=form)
    if indicators:
        clean = read_table(spark, f"{output_dir}/market_clean", form)
        sinks.write_table(ba.crypto_features(clean, total, **options), f"{output_dir}/indicators", form=form)
        if cycles:
            sinks.write_table(ba.crypto_cycles(read_table(spark, f"{output_dir}/indicators", form)), f"{output_dir}/market_cycles", form=form)
    documents = None
    for kind, least in (("info", 1), ("network_data", 3)):  # a network document of two fields is only its symbol and an error
        found = _documents(spark, input_dir, kind, layout, coin, least)
        sinks.write_documents(found.where("fit").drop("fit"), f"{output_dir}/{kind.split('_')[0]}_clean")
        part = found.groupBy("series").agg(F.max("fit").alias(kind))
        documents = part if documents is None else documents.join(part, "series", "full_outer")
    there = F.coalesce(F.col("status") == files.PROCESSED, F.lit(False))
    summary = status.join(documents, "series", "full_outer").select(
        F.upper("series").alias("series"), F.coalesce("status", F.lit("no market data")).alias("status"), F.coalesce("records", F.lit(0)).alias("records"),
        there.alias("market_data"), *[F.coalesce(k, F.lit(False)).alias(k) for k in ("info", "network_data")],
        (there & F.lit(indicators)).alias("indicators"), (there & F.lit(indicators and cycles)).alias("market_cycles"))
    return _report(summary, output_dir)


def process_company_directory(spark: SparkSession, input_dir: str, output_dir: str, ratios: bool = True, layout: str = NAMED) -> DataFrame:
    """Company folders to ``income_clean``, ``balance_clean``, ``ratios_clean`` and ``additional_ratios`` (nested documents).

    The summary has a row per company: which of income_statement, balance_sheet, ratios and additional_ratios there are.
    """
    company = _name(layout, F.lower(files.parent_name(FILE)))
    flags, clean = None, {}
    for name, kind, tidy in (("income", "income_statement", co.clean_income_statement), ("balance", "balance_sheet", co.clean_balance_sheet)):
        place = _place(input_dir, kind, layout, f"*_{kind}.csv")
        found = files.listing(spark, *place).select(company.alias("company"))
        lines = files.wide_statements(spark, *place, company)
        sinks.write_table(tidy(lines), f"{output_dir}/{name}_clean", by=("company",), form="parquet")
        clean[name] = spark.read.parquet(f"{output_dir}/{name}_clean").withColumn("company", F.col("company").cast("string"))
        part = found.distinct().join(lines.groupBy("company").agg(F.lit(True).alias(kind)), "company", "left")
        flags = part if flags is None else flags.join(part, "company", "full_outer")
    given = _documents(spark, input_dir, "ratios", layout, company, 1).withColumnRenamed("series", "company")
    tidy_ratios = staged(co.normalize_ratios(payloads.ratio_document(given.where("fit"))))
    sinks.write_documents(nested(tidy_ratios, ["section", "ratio", "period"]), f"{output_dir}/ratios_clean")
    flags = flags.join(given.groupBy("company").agg(F.max("fit").alias("ratios")), "company", "full_outer")
    if ratios:
        more = staged(co.financial_ratios(clean["income"], clean["balance"]))
        sinks.write_documents(nested(more, ["period", "section", "ratio"]), f"{output_dir}/additional_ratios")
        flags = flags.join(more.select("company", F.lit(True).alias("additional_ratios")).distinct(), "company", "left")
    else:
        flags = flags.withColumn("additional_ratios", F.lit(False))
    return _report(flags.where(~F.col("company").isin(*NOT_SERIES)).select("company", *[
        F.coalesce(c, F.lit(False)).alias(c) for c in ("income_statement", "balance_sheet", "ratios", "additional_ratios")]), output_dir)


def nested(df: DataFrame, levels: Sequence[str], key: str = "company", value: str = "value") -> DataFrame:
    """One document per key: maps of maps down the ``levels``. A company's ratios and periods bound a document's size."""
    levels = list(levels)
    out, inner = df, F.col(value)
    while levels:
        level = levels.pop()
        entry = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(level).alias("key"), inner.alias("value"))), _by_key))
        out, inner = out.groupBy(key, *levels).agg(entry.alias("document")), F.col("document")
    return out


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


def read_table(spark: SparkSession, path: str, form: str = "parquet", day: str = "date") -> DataFrame:
    """What :func:`tidemark.sources.sinks.write_table` wrote; numbers and days of CSV are read from the header's columns."""
    if form != "csv":
        return spark.read.parquet(path).withColumn("symbol", F.col("symbol").cast("string"))
    try:
        rows = spark.read.option("header", True).csv(path)
    except AnalysisException:  # a batch without a single row leaves nothing to take a header from
        return spark.createDataFrame([], f"symbol string, {day} date")
    kinds = {day: "date", "symbol": "string"}
    return rows.select(*[F.col(f"`{c}`").try_cast(kinds.get(c, "string" if c.endswith("_label") and c != "trend_label" else "double")).alias(c) for c in rows.columns])


def _documents(spark: SparkSession, folder: str, kind: str, layout: str, series: Column, least: int) -> DataFrame:
    """``(series, payload, fit)``: fit where the document is an object of at least so many fields."""
    place, pattern = _place(folder, kind, layout, f"*_{kind}.json")
    shape = "series string, payload string"
    if layout == WRITTEN:
        try:
            given = spark.read.schema(shape).json(place)
        except AnalysisException:  # no documents of this kind
            given = spark.createDataFrame([], shape)
    else:
        text = spark.read.text(place, pathGlobFilter=pattern, wholetext=True, recursiveFileLookup=True)
        found = text.select(F.col(files.FILE).alias("file"), F.col("value").alias("payload")).select(series.alias("series"), "payload")
        blank = files.listing(spark, place, pattern).select(series.alias("series")).join(found.select("series"), "series", "left_anti")
        given = found.unionByName(blank, allowMissingColumns=True)
    return given.withColumn("fit", F.coalesce(F.size(F.json_object_keys("payload")) >= least, F.lit(False)))


def _global_market(spark: SparkSession, input_dir: str, output_dir: str, layout: str) -> DataFrame | None:
    place, pattern = _place(input_dir, "global_market_data", layout, "global_market_data.json")
    try:
        raw = spark.read.text(place, pathGlobFilter=pattern, wholetext=True).select(F.col("value").alias("payload"))
    except AnalysisException:
        return None
    if raw.isEmpty():
        return None
    sinks.write_documents(raw, f"{output_dir}/global_market_data_clean")
    total = staged(payloads.global_market(raw))
    return None if total.isEmpty() else total


def _report(summary: DataFrame, output_dir: str) -> DataFrame:
    path = f"{output_dir}/processing_results"
    summary = staged(summary)
    sinks.write_documents(summary, path)
    return summary


# -- loading -------------------------------------------------------------------------------------


def load_stock_directory(spark: SparkSession, root: str, directory: str, kind: str = "stock", register: bool = True, pattern: str = "*_processed.csv",
                         layout: str = NAMED, batch: str | None = None) -> DataFrame:
    """Files to assets, prices and indicators of the star schema: per symbol status, message and counts, also in the run log.

    Symbols are upper case, those of indices with a caret. Unknown ones are registered, or are errors if ``register`` is off.
    """
    began = time.monotonic()
    name = stock_symbol(_name(layout, files.file_symbol(FILE)), F.lit(kind == "index"))
    rows, status = _sorted_out(spark, *_place(directory, "processed", layout, pattern), None, name, None)
    names = F.coalesce(payloads.look_up("symbol", payloads.INDEX_NAMES), F.col("symbol")) if kind == "index" else F.col("symbol")
    rows = staged(rows)
    loads = {"prices": ("stock_price", rows, up.stock_price_rows)}
    if any(c.startswith(INDICATOR_MARKS) for c in rows.columns):
        loads["indicators"] = ("technical_indicator", rows, up.indicator_rows)
    return _load(spark, root, status, loads, kind, names, register, batch, directory, f"load_{kind}_data_", began)


def load_crypto_directory(spark: SparkSession, root: str, directory: str, register: bool = True, layout: str = NAMED, batch: str | None = None) -> DataFrame:
    """Coin folders to assets, market data, network data and indicators: per symbol status, message and counts, also in the run log.

    A coin's best market file counts: cycles before indicators before cleaned data; indicators come from the first two. Its name
    is that of its description, the cleaned one first.
    """
    began = time.monotonic()
    coin = F.upper(_name(layout, files.parent_name(FILE)))
    sources, status = [], None
    for kind in ("market_cycles", "indicators", "market_clean"):
        rows, state = _sorted_out(spark, *_place(directory, kind, layout, f"*_{kind}.csv"), None, coin, None)
        sources.append((kind, rows))
        status = state if status is None else status.unionByName(state)
    best = F.min_by("status", F.when(F.col("status") == files.PROCESSED, 0).otherwise(1))
    market = staged(files.by_priority(sources))
    info, network = (_first_document(spark, directory, k, layout, coin) for k in ("info", "network"))
    found = status.select("series").unionByName(info.select("series")).unionByName(network.select("series")).distinct()
    status = staged(found.join(status.groupBy("series").agg(best.alias("status"), F.max("records").alias("records")), "series", "left").where(
        ~F.lower("series").isin(*NOT_SERIES)).select("series", F.coalesce("status", F.lit(files.PROCESSED)).alias("status"), F.coalesce("records", F.lit(0)).alias("records")))
    named = status.join(info.select("series", F.get_json_object("payload", "$.name").alias("_name")), "series", "left")
    loads = {
        "market_data": ("crypto_market_data", market, up.coin_market_rows),
        "network_data": ("crypto_network_data", network.withColumnRenamed("series", "symbol"), _network_records),
    }
    if up.indicator_columns(market, crypto=True):
        loads["indicators"] = ("technical_indicator", market.where("source <> 'market_clean'"), lambda df: up.indicator_rows(df, crypto=True))
    names = F.coalesce(F.when(F.col("_name") != "", F.col("_name")), F.col("symbol"))
    return _load(spark, root, staged(named), loads, "crypto", names, register, batch, directory, "load_crypto_data_", began)


def _first_document(spark: SparkSession, directory: str, kind: str, layout: str, coin: Column) -> DataFrame:
    """``(series, payload)`` of the cleaned document, else the raw one."""
    kinds = (f"{kind}_clean", "network_data" if kind == "network" else kind)
    parts = [_documents(spark, directory, name, layout, coin, 1).where("fit").withColumn("_rank", F.lit(rank)) for rank, name in enumerate(kinds)]
    both = parts[0].unionByName(parts[1]).withColumn("series", F.upper("series"))
    return staged(both.groupBy("series").agg(F.min_by("payload", "_rank").alias("payload")))


def _network_records(df: DataFrame) -> DataFrame:
    """Scalar fields of network documents, an object or a list of them, as rows under their canonical names."""
    record = "map<string,string>"
    many = F.coalesce(F.from_json("payload", f"array<{record}>"), F.array(F.from_json("payload", record)))
    rows = df.select("asset_id", F.explode(many).alias("r"))
    cell = lambda n: F.try_element_at("r", F.lit(n))
    best = {name: F.coalesce(*[cell(n) for n in (name, *reversed(aliases))]) for name, aliases in up.NETWORK_ALIASES.items()}
    return up.network_rows(rows.select("asset_id", *[
        (F.to_date(F.try_to_timestamp(c)) if n == "trade_date" else c.try_cast("double")).alias(n) for n, c in best.items()]))


def _load(spark, root, status, loads, kind, names, register, batch, directory, process, began) -> DataFrame:
    """Register, load every table in one merge, and report per symbol."""
    ident = batch or f"{process}{directory}@{time.time_ns()}"
    fit = status.where(F.col("status") == files.PROCESSED).withColumn("symbol", F.col("series"))
    if register:
        known = sinks.read_star(spark, root, "asset").select("symbol")
        sinks.load_assets(spark, root, fit.join(known, "symbol", "left_anti").select("symbol", names.alias("name"), F.lit(kind).alias("asset_type")), f"{ident}#assets")
    assets = staged(sinks.read_star(spark, root, "asset").select("asset_id", "symbol"))
    report = status.withColumnRenamed("series", "symbol").join(assets, "symbol", "left")
    problem = F.when(F.col("status") != files.PROCESSED, F.col("status")).when(F.col("asset_id").isNull(), "asset not found")
    columns, records = [], F.lit(0)
    for part, (table, rows, shape) in loads.items():
        shaped = shape(up.with_asset_id(rows, assets)[0])
        keys = set(schemas.STAR[table][1])
        if keys < set(shaped.columns):  # no file had such columns otherwise
            sinks.upsert_star(spark, root, table, shaped, batch=f"{ident}#{part}")
        tally = sinks.load_counts(spark, root, table, f"{ident}#{part}", ["asset_id"]).groupBy("asset_id").agg(*[
            F.sum(F.when(F.col("action") == a, F.col("records")).otherwise(0)).alias(f"{part}_{a}") for a in ("inserted", "updated", "ignored")])
        report = report.join(tally, "asset_id", "left")
        columns += [f"{part}_{a}" for a in ("inserted", "updated", "ignored")]
        records = records + F.coalesce(f"{part}_inserted", F.lit(0)) + F.coalesce(f"{part}_updated", F.lit(0))
    report = staged(report.select(
        "symbol", "asset_id", F.when(problem.isNull(), "success").otherwise("error").alias("status"), problem.alias("message"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in columns], records.alias("_records")))
    seconds = time.monotonic() - began
    sinks.append_logs(report.select(F.concat(F.lit(process), "symbol").alias("process_name"), F.when(F.col("status") == "success", "success").otherwise("failed").alias("status"),
                                    F.col("message").alias("error_message"), F.col("_records").alias("records_processed"), F.lit(None).cast("double").alias("execution_duration")), f"{root}/{sinks.LOG}")
    tally = report.agg(F.count(F.lit(1)).alias("n"), F.count("message").alias("bad")).first()
    sinks.append_log(spark, f"{root}/{sinks.LOG}", f"batch_load_{kind}_{directory.rstrip('/').rsplit('/', 1)[-1]}",
                     "partial_success" if tally.bad else "success", tally.n, seconds)
    return report.drop("_records")
