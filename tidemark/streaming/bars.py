"""Streaming: ticks to bars with a watermark, and upserts per micro-batch.

Only operators that look back are offered here; those that use future rows are batch-only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import shared_folder
from tidemark.sources import sinks


def tick_bars(ticks: DataFrame, symbol: str, at: str, price: str, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """OHLC bars and trade counts per symbol and time window; a bar is final once the watermark passes it.

    The aggregate combines map-side, so a heavy symbol costs one state row per window.
    """
    ticks = ticks.withColumn(at, F.col(at).cast("timestamp"))
    grouped = ticks.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), F.col(symbol).alias("symbol"))
    return grouped.agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    ).select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")


def write_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is there to Parquet, then stop."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def upsert_stream(stream: DataFrame, root: str, table: str, checkpoint: str, sequence: str | None = None, name: str | None = None) -> StreamingQuery:
    """Merge every micro-batch into a star table, exactly once.

    The commit that switches the table to a micro-batch's rows also records its number, under ``name`` (default: the
    checkpoint). After a crash the same number comes again with the same rows: it is done if the record is not there, and
    left alone if it is. ``sequence`` (an offset or event time of the source) orders records of one key inside a batch.
    """

    def load(batch: DataFrame, number: int) -> None:
        sinks.upsert_star(batch.sparkSession, root, table, batch, sequence, batch=f"{name or checkpoint}#{number}")

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fresh_folder(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tidemark-stream/{name}-{uuid.uuid4().hex}"
