"""Writers: tables, documents, matrices, run logs and partition-wise upserts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.upsert import counts, merge, register_assets
from tidemark.sources import versions

MONTH = "month"
#: The run log, which only grows and needs no versions.
LOG = "etl_log"


def write_table(df: DataFrame, path: str, by: Sequence[str] = ("symbol",), form: str = "parquet") -> None:
    """One dataset partitioned by symbol (CSV is possible too)."""
    # rebalance: files of even size, a heavy symbol split over several tasks
    writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    (writer.option("header", True).csv if form == "csv" else writer.parquet)(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Result rows as JSON lines; structs, arrays and maps nest."""
    df.write.mode("overwrite").json(path)


def matrix_wide(pairs: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Symmetric matrix with ones on the diagonal, one column per symbol."""
    flipped = pairs.select(F.col("symbol_2").alias("symbol_1"), F.col("symbol_1").alias("symbol_2"), "corr")
    diagonal = pairs.select("symbol_1").unionByName(pairs.select(F.col("symbol_2").alias("symbol_1"))).distinct()
    full = pairs.select("symbol_1", "symbol_2", "corr").unionByName(flipped).unionByName(
        diagonal.select("symbol_1", F.col("symbol_1").alias("symbol_2"), F.lit(1.0).alias("corr")))
    return full.groupBy("symbol_1").pivot("symbol_2", list(symbols)).agg(F.first("corr"))


def status_summary(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("records"))


def append_logs(entries: DataFrame, path: str) -> None:
    """Many log entries at once; each gets an id and the time of writing."""
    entries.select(F.expr("uuid()").alias("log_id"), "process_name", F.current_timestamp().alias("execution_time"), "status", "error_message",
                   "records_processed", "execution_duration").write.mode("append").parquet(path)


def append_log(spark: SparkSession, path: str, process: str, status: str, records: int, seconds: float, error: str | None = None) -> None:
    row = [(uuid.uuid4().hex, process, None, status, error, records, seconds)]
    log = spark.createDataFrame(row, schemas.STAR[LOG][0]).withColumn("execution_time", F.current_timestamp())
    log.write.mode("append").parquet(path)


def _shape(table: str) -> tuple[str, str]:
    """(columns as read, with the month; the month column or "")"""
    columns, _, time = schemas.STAR[table]
    shape = columns if "created_at" in columns else f"{columns}, created_at timestamp"
    return (f"{shape}, {MONTH} string", MONTH) if time else (shape, "")


def read_star(spark: SparkSession, root: str, table: str, months: Sequence[str] | None = None) -> DataFrame:
    """A star-schema table, empty if never written; of the given months (``yyyy-MM``) only."""
    if table == LOG:
        try:
            return spark.read.schema(schemas.STAR[LOG][0]).parquet(f"{root}/{LOG}")
        except AnalysisException:
            return spark.createDataFrame([], schemas.STAR[LOG][0])
    return versions.read(spark, f"{root}/{table}", _shape(table)[0], months)


def _replace(spark: SparkSession, root: str, table: str, base: versions.Version, merged: DataFrame, months: Sequence[str] | None, batch: str | None) -> DataFrame:
    """Write merged rows (with ``action``), then switch the table to them; ``(action, records)``."""
    path, (shape, by) = f"{root}/{table}", _shape(table)
    ident = versions.write(merged, path, by)
    tally = counts(versions.written(spark, path, ident, f"{shape}, action string")).collect()  # one row per action
    parts = {m: f"batch={ident}/{by}={m}" for m in months} if by else {versions.WHOLE: f"batch={ident}"}
    counted = [(r.action, r.records) for r in tally]
    versions.commit(spark, path, base, parts, counted, batch)
    return spark.createDataFrame(counted, "action string, records bigint")


def upsert_star(spark: SparkSession, root: str, table: str, incoming: DataFrame, sequence: str | None = None, batch: str | None = None) -> DataFrame:
    """Merge rows into a table and give the counts by action.

    Only the months present in the input are read, joined and rewritten. The table switches to the new files in one
    step (see :mod:`tidemark.sources.versions`): a job that fails before leaves it as it was. ``batch`` names
    the load; if one of that name is recorded already, its counts are given and nothing is done.
    """
    path, keys = f"{root}/{table}", schemas.STAR[table][1]
    if batch is not None and (done := versions.recorded(spark, path, batch)) is not None:
        return done
    base, months = versions.current(spark, path), None
    if time := schemas.STAR[table][2]:
        incoming = incoming.withColumn(MONTH, F.date_format(time, "yyyy-MM"))
        months = [r[0] for r in incoming.select(MONTH).distinct().collect()]  # calendar months: they name the folders read
        keys = (MONTH, *keys)
    merged = merge(read_star(spark, root, table, months), incoming, keys, sequence)
    return _replace(spark, root, table, base, merged.withColumn("created_at", F.coalesce("created_at", F.current_timestamp())), months, batch)


def load_assets(spark: SparkSession, root: str, incoming: DataFrame, batch: str | None = None) -> DataFrame:
    """Register assets in the star schema: ids for new symbols, changed facts taken over, both with their times."""
    path = f"{root}/asset"
    if batch is not None and (done := versions.recorded(spark, path, batch)) is not None:
        return done
    base = versions.current(spark, path)
    return _replace(spark, root, "asset", base, register_assets(read_star(spark, root, "asset"), incoming), None, batch)


def load_counts(spark: SparkSession, root: str, table: str, batch: str, by: Sequence[str]) -> DataFrame:
    """``(by…, action, records)`` of the rows a recorded batch touched, from the files it wrote."""
    path, (shape, _) = f"{root}/{table}", _shape(table)
    folder = versions.folder_of(spark, path, batch)
    rows = spark.createDataFrame([], f"{shape}, action string") if folder is None else versions.written(spark, path, folder, f"{shape}, action string")
    return rows.where("action <> 'kept'").groupBy(*by, "action").agg(F.count(F.lit(1)).alias("records"))
