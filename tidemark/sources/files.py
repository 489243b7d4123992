"""File scans. A directory is one DataFrame; the symbol comes from the path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import to_day
from tidemark.session import staged
from tidemark.sources.payloads import one_per_pair

FILE = "_metadata.file_path"


def file_symbol(path: str | Column = FILE) -> Column:
    """File name up to the first underscore."""
    return F.split(_plain(F.regexp_extract(path, r"([^/]+)$", 1)), "_")[0]


def parent_name(path: str | Column = FILE) -> Column:
    return _plain(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1))


def partition_value(path: str | Column = FILE, column: str = "[^/=]+") -> Column:
    """The value of a partition folder ``column=value``, as Spark's writers name them."""
    return _plain(_plain(F.regexp_extract(path, f"/{column}=([^/]+)/", 1)))


def _plain(name: Column) -> Column:
    """A name out of a path, which Spark gives as a URI: ``^`` comes as ``%5E``, a plus sign as itself."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def stock_bars(spark: SparkSession, folder: str, pattern: str = "*_daily.csv", intraday: bool = False) -> DataFrame:
    """All per-symbol bar files of a folder."""
    schema = schemas.INTRADAY_BARS if intraday else schemas.STOCK_BARS
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(folder, pathGlobFilter=pattern)
    return df.withColumn("symbol", file_symbol())


# -- CSV files whose headers may differ ------------------------------------------------------------

#: What a file, or a series in several files, can come to.
PROCESSED, EMPTY = "processed", "empty"
_CELL = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_BAD = "_bad"


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``file`` of all matching files below a folder, from the file index alone: scans leave out files without a byte."""
    found = spark.read.format("binaryFile").load(folder, pathGlobFilter=pattern, recursiveFileLookup=True).inputFiles()
    return spark.createDataFrame([(f,) for f in found], "file string")


def csv_rows(spark: SparkSession, folder: str, pattern: str, key: str = "date") -> DataFrame:
    """All rows of CSV files with differing headers: ``file``, ``line`` (the raw line where it has too many cells) and every column as text.

    Files of the same header are one scan; there are as many scans as headers. A header is the line with a cell ``key``;
    files without one give no rows. Names are taken in lower case, columns a file lacks are NULL.
    """
    word = rf'(?i)(^|,)\s*"?{key}"?\s*(,|$)'
    heads = spark.read.text(folder, pathGlobFilter=pattern, recursiveFileLookup=True).where(F.col("value").rlike(word))
    heads = staged(heads.select(F.col(FILE).alias("file"), F.trim("value").alias("head")))
    out = None
    for (head,) in heads.select("head").distinct().collect():  # kinds of files, not files
        names = [c.strip().strip('"').lower() or f"_{k}" for k, c in enumerate(head.split(","))]
        shape = ", ".join(f"`{c}` string" for c in names) + f", {_BAD} string"
        rows = spark.read.schema(shape).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", _BAD).csv(folder, pathGlobFilter=pattern, recursiveFileLookup=True)
        rows = rows.select(F.col(FILE).alias("file"), *[F.col(f"`{c}`") for c in names], F.when(
            F.size(F.split(_BAD, _CELL, -1)) > len(names), F.col(_BAD)).alias("line"))
        rows = rows.join(heads.where(F.col("head") == head).select("file"), "file", "left_semi")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], f"file string, line string, `{key}` string")


def typed(rows: DataFrame, numbers: Sequence[str] | None = None, key: str = "date") -> DataFrame:
    """Text cells as a day in ``key`` and numbers elsewhere (``numbers``: which; default all), NULL where they cannot be read."""
    keep = {"file", "line", "series", key}
    wanted = [c for c in rows.columns if c not in keep] if numbers is None else list(numbers)
    have = {c: F.col(f"`{c}`").try_cast("double") if c in rows.columns else F.lit(None).cast("double") for c in wanted}
    return rows.select(*[c for c in ("series", "file", "line") if c in rows.columns], to_day(key).alias(key), *[v.alias(c) for c, v in have.items()])


def series_status(files_: DataFrame, rows: DataFrame, key: str = "date") -> DataFrame:
    """``(series, status, records)``: processed, empty, or what is wrong. ``files_`` and ``rows`` carry ``series``.

    A series with a line of too many cells or without a readable day is rejected as a whole, as no later step could order it.
    """
    seen = rows.groupBy("series").agg(
        F.count(F.lit(1)).alias("records"), F.count("line").alias("_torn"), F.count(F.when(F.col(key).isNull(), 1)).alias("_undated"))
    every = files_.select("series").distinct().join(seen, "series", "left")
    status = (F.when(F.col("_torn") > 0, F.concat(F.lit("error: lines with too many cells: "), "_torn"))
              .when(F.col("_undated") > 0, F.concat(F.lit(f"error: rows without a {key}: "), "_undated"))
              .when(F.col("records") > 0, PROCESSED).otherwise(EMPTY))
    return every.select("series", status.alias("status"), F.coalesce("records", F.lit(0)).alias("records"))


def coin_series(spark: SparkSession, folder: str, exclude: Sequence[str] = ()) -> DataFrame:
    """``<coin>/<coin>_market_data.csv`` of every coin folder but the excluded ones."""
    df = spark.read.schema(schemas.COIN_SERIES).option("header", True).csv(f"{folder}/*/*_market_data.csv")
    return df.withColumn("symbol", parent_name()).where(~F.col("symbol").isin(*exclude)) if exclude else df.withColumn("symbol", parent_name())


def wide_statements(spark: SparkSession, folder: str, pattern: str, company: Column | None = None) -> DataFrame:
    """Statement files, wide by period with differing headers, in long form.

    Files are read as text, so any mix of headers is one scan: the header travels to its lines by
    a join on the file, and cells are split where the comma is outside quotes.
    """
    raw = spark.read.text(folder, pathGlobFilter=pattern, wholetext=True, recursiveFileLookup=True)
    named = raw.select(F.col(FILE).alias("file"), "value")
    lines = named.select((file_symbol("file") if company is None else company).alias("company"), F.split("value", r"\r?\n").alias("lines"))
    comma = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    clean = lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"|"$', ""), F.lit('""'), F.lit('"'))
    cells = lambda c: F.transform(F.split(c, comma, -1), clean)
    rows = lines.select("company", cells(F.col("lines")[0]).alias("head"), F.posexplode("lines").alias("line", "text")).where("line > 0 and trim(text) <> ''")
    pairs = F.arrays_zip(F.slice("head", 2, 1 << 30).alias("period"), F.slice(cells(F.col("text")), 2, 1 << 30).alias("text"))
    return rows.select("company", "line", cells(F.col("text"))[0].alias("item"), F.explode(pairs).alias("e")).select(
        "company", "line", "item", "e.period", F.when(F.col("e.text") != "", F.col("e.text")).alias("text")).where("period is not null")


def documents(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Whole files as ``(symbol, payload)`` for the payload readers."""
    raw = spark.read.text(folder, pathGlobFilter=pattern, wholetext=True, recursiveFileLookup=True)
    return raw.select(file_symbol().alias("symbol"), parent_name().alias("folder"), F.col("value").alias("payload"))


def asset_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("asset_id", "symbol")


def price_table(stocks: DataFrame | None = None, coins: DataFrame | None = None, indices: DataFrame | None = None) -> DataFrame:
    """One long price table: stocks and indices give ``close``, coins ``price`` (else ``close``)."""
    parts = []
    for name, df in (("stock", stocks), ("crypto", coins), ("index", indices)):
        if df is None:
            continue
        close = F.col("close") if "close" in df.columns else F.lit(None).cast("double")
        value = F.coalesce(F.col("price"), close) if name == "crypto" and "price" in df.columns else close
        parts.append(df.select(F.lit(name).alias("asset_class"), "symbol", "date", value.alias("value")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def by_priority(sources: Sequence[tuple[str, DataFrame]], key: str = "symbol") -> DataFrame:
    """Rows of each key's best source, in the order given; columns a source lacks are NULL.

    The best source per key is a small aggregate joined back, so no key's rows meet in one task.
    """
    tagged = None
    for rank, (name, df) in enumerate(sources):
        part = df.withColumns({"source": F.lit(name), "_rank": F.lit(rank)})
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    best = tagged.groupBy(key).agg(F.min("_rank").alias("_rank"))
    return tagged.join(best, [key, "_rank"], "left_semi").drop("_rank")


def matrix_csv(spark: SparkSession, path: str) -> DataFrame:
    """Square matrix file(s): first column = row names. Numeric headers stand for the row at that position."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.col(FILE).alias("file"), F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "").alias("lines"))
    names = F.transform(F.slice("lines", 2, 1 << 30), lambda x: F.trim(F.split(x, ",")[0]))
    head = F.transform(F.slice(F.split(F.col("lines")[0], ","), 2, 1 << 30), lambda x: F.trim(x))
    numbered = F.forall(head, lambda h: h.rlike(r"^\d+$"))
    rows = lines.select("file", F.when(numbered, names).otherwise(head).alias("cols"), F.explode(F.slice("lines", 2, 1 << 30)).alias("row"))
    parts = F.split("row", ",", -1)
    pairs = F.arrays_zip(F.col("cols").alias("symbol_2"), F.slice(parts, 2, 1 << 30).alias("v"))
    long = rows.select("file", F.trim(parts[0]).alias("symbol_1"), F.explode(pairs).alias("e"))
    long = long.select("file", "symbol_1", "e.symbol_2", F.trim("e.v").try_cast("double").alias("corr"))
    return one_per_pair(long, ["file"])


def dated_matrices(spark: SparkSession, path: str, date_column: str = "date") -> DataFrame:
    """A CSV with one row per date and matrix row: ``date, name, <symbols…>`` in long form."""
    df = spark.read.option("header", True).csv(path)
    name = next(c for c in df.columns if c != date_column)
    symbols = [c for c in df.columns if c not in (date_column, name)]
    long = df.unpivot([date_column, name], symbols, "symbol_2", "corr")
    return one_per_pair(long.select(
        F.to_date(date_column).alias("calc_date"), F.col(name).alias("symbol_1"), "symbol_2", F.col("corr").try_cast("double").alias("corr")), ["calc_date"])
