"""Alignment of price series of several assets and classes, from long rows ``(asset_class, asset, date, value)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 5


def in_range(df: DataFrame, first: str | Column | None = None, last: str | Column | None = None, order: str = "date") -> DataFrame:
    """Rows from ``first`` to ``last``, bounds included; a missing bound is none."""
    for bound, keep in ((first, lambda x: F.col(order) >= x), (last, lambda x: F.col(order) <= x)):
        if bound is not None:
            df = df.where(keep(F.lit(bound).cast("date") if isinstance(bound, str) else bound))
    return df


def enough_rows(df: DataFrame, least: int = MIN_ROWS, keys: Sequence[str] = ("asset_class", "asset")) -> DataFrame:
    """Rows of the assets with at least ``least`` of them; counted map-side, joined by one small row per asset."""
    known = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(*keys)
    return df.join(known, list(keys), "left_semi")


def align_outer(df: DataFrame, assets: Sequence[str], classes: Sequence[str] | None = None) -> DataFrame:
    """One row per date with a column per asset, NULL where it has none; of some classes only, or of all."""
    rows = df if classes is None else df.where(F.col("asset_class").isin(*classes))
    return rows.where(F.col("asset").isin(*assets)).groupBy("date").pivot("asset", list(assets)).agg(F.first("value"))


def align_classes(df: DataFrame, left: str, right: str) -> DataFrame:
    """Values of two classes on their common dates, long: ``(date, left, right, left_value, right_value)``.

    An asset that stands in both classes counts as one of the left class.
    """
    one = df.where(F.col("asset_class") == left).select("date", F.col("asset").alias("left"), F.col("value").alias("left_value"))
    two = df.where(F.col("asset_class") == right).select("date", F.col("asset").alias("right"), F.col("value").alias("right_value"))
    two = two.join(one.select(F.col("left").alias("right")).distinct(), "right", "left_anti")
    return one.join(two, "date").select("date", "left", "right", "left_value", "right_value")


def top_assets(listing: DataFrame, count: int = 100, by: str = "market_cap", symbol: str = "symbol") -> DataFrame:
    """The ``count`` assets with the largest value; the first by name on a tie."""
    return listing.orderBy(F.desc(by), symbol).limit(count)
