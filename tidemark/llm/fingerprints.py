"""Document fingerprints that scale with the document: every shingle hash below a fixed fraction is kept.

A shingle is five consecutive words (a shorter text is one shingle). Its hash is the first 64 bits of its MD5
in hexadecimal, so comparing strings compares numbers and other systems can rebuild the sketch. Hashes in the
lowest ``1 / SCALE`` of the range are kept; where none falls there, the smallest one is. A sketch of a union of
texts is therefore a function of the texts' sketches (``merge``), and two sketches of very unequal documents
estimate containment without bias, since both sample the same part of the hash range.

Everything is DataFrame work on the JVM. Finding each document's successor needs no global window: ids are cut
into at most ``2 ** 16`` ranges, the first document of a range is copied into the range before it, and a window
inside each range does the rest. The table of ranges is the only thing broadcast; its size has that bound.

Defined cases: NULL and empty texts have the empty sketch; two empty sketches are alike (1), an empty and a
non-empty one are not (0). Rows with equal ids follow each other by text; rows without an id come first. A table of
one row is its own successor. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import SPACE, whole, words

SCALE = 8
SHINGLE = 5
#: First hexadecimal digit that is outside the kept fraction.
LIMIT = format(16 // SCALE, "x")
RANGES = 1 << 16
RANGE_DOCS = 256


def add_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the sketch of a text column: an ascending array of 16-digit hexadecimal hashes without repeats."""
    w, h = f"_w_{name}", f"_h_{name}"
    shingle = "concat({})".format(", ' ', ".join(f"get({w}, i + {k})" for k in range(SHINGLE)))
    hashes = f"""case when size({w}) >= {SHINGLE} then transform(sequence(0, size({w}) - {SHINGLE}), i -> md5(cast({shingle} as binary)))
                      when size({w}) > 0 then array(md5(cast(array_join({w}, ' ') as binary)))
                      else cast(array() as array<string>) end"""
    df = df.withColumn(w, words(F.col(text))).withColumn(h, F.expr(hashes))
    low = F.filter(h, lambda x: x < LIMIT)
    df = df.withColumn(name, low).withColumn(name, F.when((F.size(name) == 0) & (F.size(h) > 0), F.array(F.array_min(h))).otherwise(F.col(name)))
    return df.withColumn(name, F.array_sort(F.array_distinct(F.transform(name, lambda x: F.substring(x, 1, 16))))).drop(w, h)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda x: x < LIMIT)
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingle sets."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / F.greatest(union, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has too."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))


def with_next(df: DataFrame, key: str, order: list[str], carry: list[str]) -> DataFrame:
    """Add ``next_<column>`` for each carried column, taken from the row that follows by key, then by ``order``.

    The last row is followed by the first.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(RANGE_DOCS, (high - low) // RANGES + 1)
    ranged = df.withColumn("_range", F.coalesce(F.floor((F.col(key) - low) / width), F.lit(-1)).cast("long"))
    by_range = Window.orderBy("_range")  # over the table of ranges: RANGES + 2 rows at most
    first = ranged.groupBy("_range").agg(F.min(key).alias("_first")).withColumn("_to", F.lag("_range").over(by_range))
    first = first.withColumn("_to", F.coalesce("_to", F.max("_range").over(Window.partitionBy())))
    heads = ranged.alias("d").join(
        F.broadcast(first.alias("f")), (F.col("d._range") == F.col("f._range")) & F.col(f"d.{key}").eqNullSafe(F.col("f._first"))
    ).select(*[f"d.{c}" for c in df.columns], F.col("_to").alias("_range"), F.lit(True).alias("_guest"))
    # The guest of the last range is the first row of all; a single range is followed by itself.
    rows = ranged.withColumn("_guest", F.lit(False)).unionByName(heads)
    after = Window.partitionBy("_range").orderBy("_guest", F.col(key).asc_nulls_first(), *order)
    return rows.withColumns({f"next_{c}": F.lead(c).over(after) for c in carry}).filter(~F.col("_guest")).drop("_range", "_guest")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: every document's sketch beside that of its edited text and of its successor."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", whole(F.col("text")).alias("text"))
    df = with_next(add_sketch(docs, "text", "own"), "doc_id", ["text"], ["text", "own"])
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    half = F.expr("cast(floor(n_chars / 2) as int)")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    df = add_sketch(df.withColumn("edited", edited), "edited", "new")
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("own", "").alias("fingerprint"), F.array_join("new", "").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        containment(F.col("own"), F.col("next_own")).alias("in_next"))


def _sketch_sql(text: str) -> str:
    w = f"list_filter(string_split_regex({text}, '{SPACE}'), lambda x: x <> '')"
    hashes = f"""(select case when len(w) >= {SHINGLE} then list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: md5(array_to_string(w[i:i + {SHINGLE - 1}], ' ')))
                 when len(w) > 0 then [md5(array_to_string(w, ' '))] else cast([] as varchar[]) end as h from (select {w} as w))"""
    return f"""(select list_sort(list_distinct(list_transform(case when len(list_filter(h, lambda x: x < '{LIMIT}')) = 0 and len(h) > 0 then [list_min(h)]
               else list_filter(h, lambda x: x < '{LIMIT}') end, lambda x: x[1:16]))) from {hashes})"""


def _likeness_sql(a: str, b: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"case when len({a}) + len({b}) - {common} = 0 then 1.0::double else {common}::double / (len({a}) + len({b}) - {common}) end"


SQL = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
n as (select *, coalesce(lead(text) over o, first_value(text) over o) as next_text, length(text)::bigint as n_chars from d window o as (order by doc_id, text)),
e as (select *, substr(text, 1, n_chars - n_chars // 2) || substr(next_text, 1, n_chars // 2) as edited from n),
s as (select *, {_sketch_sql("text")} as own, {_sketch_sql("edited")} as new, {_sketch_sql("next_text")} as next_own from e)
select doc_id, n_chars, sha256(edited) as edited_sha256, array_to_string(own, '') as fingerprint, array_to_string(new, '') as edited_fingerprint,
       {_likeness_sql("own", "new")} as near_edited, {_likeness_sql("own", "next_own")} as near_next,
       case when len(own) = 0 then 1.0::double else len(list_intersect(own, next_own))::double / len(own) end as in_next
from s
"""
