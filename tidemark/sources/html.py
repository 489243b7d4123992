"""Tables in stored pages, read with regular expressions inside the JVM. Raw text is in ``html``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Class names of the tables and cells, first-header labels, link prefix.
STATEMENT_TABLE = "genTbl reportTbl"
FILING_TABLE = "tableFile2"
LABEL_HEADERS = ("period", "período", "item", "cuenta")
FILING_HOST = "https://www.sec.gov"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?is){pattern}"), F.lit(group))


def _text(html: Column) -> Column:
    """Text of a fragment: tags dropped, common entities resolved, trimmed."""
    bare = F.regexp_replace(html, "(?s)<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"'), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.regexp_replace(bare, r"^[\s ]+|[\s ]+$", "")


def _classed(css: str) -> str:
    """Pattern of the attributes of a tag up to a class that contains ``css``, in double, single or no quotes."""
    return f"""[^>]*\\sclass\\s*=\\s*(?:"[^"]*{css}[^"]*"|'[^']*{css}[^']*'|[^\\s"'>]*{css}[^\\s"'>]*)"""


def _table(css: str) -> Column:
    """Inside of the first table whose class list is or contains ``css``."""
    return F.regexp_extract("html", f'(?is)<table{_classed(css)}[^>]*>(.*?)</table>', 1)


def statement_rows(df: DataFrame, keys: Sequence[str] = ("company",)) -> DataFrame:
    """``(…, line, item, period, text, value)`` of the first statement table; text stays if not a number."""
    t = df.select(*keys, _table(STATEMENT_TABLE).alias("t"))
    head = F.transform(_all(F.regexp_extract("t", "(?is)<thead[^>]*>(.*?)</thead>", 1), "<th[^>]*>(.*?)</th>"), _text)
    t = t.select(*keys, head.alias("head"), F.regexp_extract("t", "(?is)<tbody[^>]*>(.*?)</tbody>", 1).alias("body"))
    rows = t.select(*keys, "head", F.posexplode(_all(F.col("body"), "<tr[^>]*>(.*?)</tr>")).alias("pos", "row"))
    rows = rows.withColumn("cells", F.transform(_all(F.col("row"), "<td[^>]*>(.*?)</td>"), _text)).where("size(cells) >= size(head)")
    labelled = F.lower(F.col("head")[0]).isin(*LABEL_HEADERS)
    periods = F.when(labelled, F.slice("head", 2, F.greatest(F.size("head") - 1, F.lit(0)))).otherwise(F.col("head"))
    pairs = F.arrays_zip(periods.alias("period"), F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))).alias("text"))
    long = rows.select(*keys, (F.col("pos") + 1).alias("line"), F.col("cells")[0].alias("item"), F.explode(pairs).alias("e"))
    return long.where("e.period is not null").select(
        *keys, "line", "item", "e.period", "e.text", F.replace("e.text", F.lit(","), F.lit("")).try_cast("double").alias("value"))


def ratio_rows(df: DataFrame, keys: Sequence[str] = ("company",)) -> DataFrame:
    """``(…, section, ratio, year_offset, value)``; the first value column is five years back."""
    parts = F.split("html", f"(?i)<[a-z]+{_classed('table__section')}[^>]*>")
    s = df.select(*keys, F.explode(F.slice(parts, 2, 1 << 30)).alias("s"))
    s = s.select(*keys, "s", F.regexp_extract("s", f"(?is)<[a-z0-9]+{_classed('table__title')}[^>]*>(.*?)</", 1).alias("_title")).where("_title <> ''")
    rows = s.select(*keys, _text(F.col("_title")).alias("section"), F.explode(_all(F.col("s"), f"<tr{_classed('table__row')}[^>]*>(.*?)</tr>")).alias("r"))
    cells = f"<t[dh]{_classed('table__cell')}[^>]*>.*?</t[dh]>"
    rows = rows.withColumn("cells", _all(F.col("r"), cells, 0))
    fixed = lambda c: c.rlike(f"(?i)^<t[dh]{_classed('fixed--column')}")
    rows = rows.withColumns({"name": F.filter("cells", fixed), "values": F.filter("cells", lambda c: ~fixed(c))}).where("size(name) > 0")
    long = rows.select(*keys, "section", _text(F.col("name")[0]).alias("ratio"), F.posexplode("values").alias("i", "cell"))
    text = _text(F.col("cell"))
    value = F.when(~text.isin("-", "N/A"), F.replace(text, F.lit(","), F.lit("")).try_cast("double"))
    return long.select(*keys, "section", "ratio", (F.col("i") - 5).alias("year_offset"), value.alias("value"))


def filing_rows(df: DataFrame, limit: int = 10, keys: Sequence[str] = ("company",)) -> DataFrame:
    """The page's first ``limit`` filings with at least four cells: ``(…, rank, filing_type, filing_date, filing_link)``."""
    cells = F.transform(_all(_table(FILING_TABLE), "<tr[^>]*>(.*?)</tr>"), lambda r: _all(r, "<td[^>]*>(.*?)</td>"))
    full = F.filter(F.slice(cells, 2, 1 << 30), lambda c: F.size(c) >= 4)  # without the header row
    rows = df.select(*keys, F.posexplode(F.slice(full, 1, limit)).alias("pos", "cells"))
    button = F.regexp_extract(F.col("cells")[1], r'(?is)<a(?=[^>]*id="documentsbutton")[^>]*href="([^"]*)"', 1)
    return rows.select(
        *keys, (F.col("pos") + 1).alias("rank"), _text(F.col("cells")[0]).alias("filing_type"), _text(F.col("cells")[3]).alias("filing_date"),
        F.when(button != "", F.concat(F.lit(FILING_HOST), button)).otherwise("").alias("filing_link"))
