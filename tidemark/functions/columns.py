"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(top, bottom) -> Column:
    """Division that gives NULL for a zero denominator."""
    return F.try_divide(top, bottom)


def null_if_nan(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(c), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns means missing; make it NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: null_if_nan(c) for c in floats})


def numeric_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in without]


def non_negative(column: str) -> Column:
    """Clamp below zero; NULL stays NULL."""
    return F.when(F.col(column) < 0, F.lit(0.0)).otherwise(F.col(column))


def plain_symbol(column: str | Column) -> Column:
    """Lower case, without the index caret."""
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(F.regexp_replace(c, r"\^", ""))


def stock_symbol(column: str | Column, is_index: Column | None = None) -> Column:
    """Upper case; indices get a leading caret."""
    c = F.upper(F.col(column) if isinstance(column, str) else column)
    if is_index is None:
        return c
    return F.when(is_index & ~c.startswith("^"), F.concat(F.lit("^"), c)).otherwise(c)


def to_day(column: str | Column) -> Column:
    """Date of a date, timestamp or text column; NULL if it cannot be read."""
    c = F.col(column) if isinstance(column, str) else column
    return F.to_date(F.try_to_timestamp(c.cast("string")))


def amount(text: str | Column) -> Column:
    """Number from statement text: ``(x)`` is negative; ``, $ %`` are dropped; else NULL."""
    c = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(F.regexp_replace(c, r"\((.*?)\)", "-$1"), r"[,$%]", "")
    return null_if_nan(F.trim(bare).try_cast("double"))
