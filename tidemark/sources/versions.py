"""Tables that change by switching to a new version, never in place.

A load writes its rows to a folder of its own, ``data/batch=<id>[/month=…]``, and then one manifest file that lists which
folder holds each part of the table from now on. Until that file is there, readers see the version before; a job
that dies earlier leaves a folder nobody refers to. Nothing is deleted or overwritten, so there is no moment at which
rows are missing, and parts a load does not touch keep their files.

The manifest is also the commit record: it names the batch and how many records it inserted, updated and ignored. A
batch that comes again, because a job was restarted or a micro-batch replayed, finds its record and changes nothing.

A table has one writer at a time; two that commit the same version are found out when the table is read next.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "commit string, batch string, kind string, name string, folder string, records bigint"
#: The only part of a table that is not cut by time.
WHOLE = ""


class TwoWriters(RuntimeError):
    """Two jobs have committed the same version of a table."""


@dataclass(frozen=True)
class Version:
    """One state of a table: its number, the folder of each part, and what the batch that made it did."""

    number: int
    parts: Mapping[str, str]


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{MANIFEST}, version bigint").parquet(f"{path}/manifests")
    except AnalysisException:  # never written
        return None


def current(spark: SparkSession, path: str) -> Version:
    """The newest committed version; number 0 without parts for a table never written."""
    every = _manifests(spark, path)
    newest = every.agg(F.max("version")).first()[0] if every is not None else None
    if newest is None:
        return Version(0, {})
    rows = every.where(F.col("version") == newest).collect()  # one row per calendar month, and the counts
    if len({r.commit for r in rows}) > 1:
        raise TwoWriters(f"{path}: version {newest} was committed twice")
    return Version(newest, {r.name: r.folder for r in rows if r.kind == "part"})


def recorded(spark: SparkSession, path: str, batch: str) -> DataFrame | None:
    """``(action, records)`` of a batch committed before, else None."""
    every = _manifests(spark, path)
    if every is None:
        return None
    mine = every.where(F.col("batch") == batch).where("kind <> 'part'").select("kind", "name", "records").collect()
    return _tally(spark, [(r.name, r.records) for r in mine if r.kind == "action"]) if mine else None


def folder_of(spark: SparkSession, path: str, batch: str) -> str | None:
    """The id under which a recorded batch wrote its rows; None if it is not recorded or wrote none."""
    every = _manifests(spark, path)
    row = every.where((F.col("batch") == batch) & (F.col("kind") == "commit")).first() if every is not None else None
    return row.folder.split("/")[0].removeprefix("batch=") if row is not None and row.folder else None


def _tally(spark: SparkSession, counted: Sequence[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(counted, "action string, records bigint")


def read(spark: SparkSession, path: str, shape: str, only: Sequence[str] | None = None) -> DataFrame:
    """The table's rows, of the parts in ``only`` alone if given."""
    version = current(spark, path)
    wanted = [f for p, f in sorted(version.parts.items()) if only is None or p in set(only)]
    if not wanted:
        return spark.createDataFrame([], shape)
    folders = [f"{path}/data/{f}" for f in wanted]
    return spark.read.schema(shape).option("basePath", f"{path}/data").parquet(*folders).drop("batch")


def write(df: DataFrame, path: str, by: str | None = None) -> str:
    """Rows to a folder of their own, not yet part of the table; gives the folder's id."""
    ident = uuid.uuid4().hex
    folder = f"{path}/data/batch={ident}"
    if by:
        df.hint("rebalance", by).write.partitionBy(by).parquet(folder)
    else:
        df.hint("rebalance").write.parquet(folder)
    return ident


def written(spark: SparkSession, path: str, ident: str, shape: str) -> DataFrame:
    """What :func:`write` wrote under an id, the part column included."""
    return spark.read.schema(shape).parquet(f"{path}/data/batch={ident}")


def commit(spark: SparkSession, path: str, base: Version, parts: Mapping[str, str], counted: Sequence[tuple[str, int]], batch: str | None = None) -> Version:
    """Switch to the version after ``base``: its parts, replaced or joined by ``parts``. One file, so all or nothing."""
    ident = uuid.uuid4().hex
    new = Version(base.number + 1, {**base.parts, **parts})
    if current(spark, path).number != base.number:
        raise TwoWriters(f"{path}: another job has committed since version {base.number} was read")
    rows = [(ident, batch, "part", name, folder, None) for name, folder in new.parts.items()]
    rows += [(ident, batch, "action", name, None, n) for name, n in counted] + [(ident, batch, "commit", None, next(iter(parts.values()), None), None)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifests/version={new.number}")
    return new


def unreferenced(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Batch folders that none of the last ``keep`` versions uses: failed loads and replaced parts, free to be removed."""
    every, newest = _manifests(spark, path), current(spark, path).number
    used = set()
    if every is not None:
        folders = every.where((F.col("version") > newest - keep) & (F.col("kind") == "part")).select(F.split("folder", "/")[0].alias("f")).distinct()
        used = {r.f for r in folders.collect()}
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/data").select(
            F.regexp_extract("path", "/data/(batch=[^/]+)/", 1).alias("f")).distinct().collect()
    except AnalysisException:
        return []
    return sorted({r.f for r in files} - used)
