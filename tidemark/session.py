"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job should run with. ANSI mode stays on, as Spark ships it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with :data:`SETTINGS`; keyword extras use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of :data:`SETTINGS` to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Bounds of the Arrow batches in which texts travel to Python workers and back. Spark's own bound is 10,000 rows of any length.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def text_batches(spark: SparkSession) -> SparkSession:
    """Keep the batches of texts small, since a task holds several at a time outside the heap. Smaller bounds set before stay."""
    for key, most in TEXT_BATCHES.items():
        try:
            smaller = 0 < int(spark.conf.get(key)) <= most
        except ValueError:  # a size with a unit
            smaller = False
        if not smaller:
            spark.conf.set(key, str(most))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (a test) falls back to a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For a result that several branches of a plan read: they then scan the columns they need instead
    of repeating its history, and a lost executor costs no more than a re-read. The folder's own
    retention rules remove the tables.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
