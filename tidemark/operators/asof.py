"""Nearest-date join of a value known on some dates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import _neighbours
from tidemark.operators.series import lay_out
from tidemark.session import staged


def nearest_by_date(df: DataFrame, known: DataFrame, value: str, order: str = "date", block_rows: int | None = None) -> DataFrame:
    """Add ``value`` from the row of ``known`` with the nearest date; a tie takes the later date.

    The distinct dates of both sides (bounded by the calendar) are resolved once, in blocks, and
    joined back by date. ``known`` holds one row per date.
    """
    dates = df.select(order).distinct().join(known.select(order, value), order, "full")
    # written once: numbering, blocks and carries read it again and again
    dates = staged(dates.withColumn("_all", F.lit(1)).withColumn("_day", F.when(F.col(value).isNotNull(), F.col(order))))
    s = lay_out(dates, keys=("_all",), order=order, block_rows=block_rows)
    s, near = _neighbours(s, ["_day", value])
    (day_before, day_after), (before, after) = near["_day"], near[value]
    closer = F.datediff(order, day_before["x"]) < F.datediff(day_after["x"], F.col(order))
    picked = (
        F.when(day_before.isNull(), after["x"]).when(day_after.isNull(), before["x"])
        .when(closer, before["x"]).otherwise(after["x"])
    )
    resolved = s.add({"_picked": picked}).rows().select(order, F.col("_picked").alias(value))
    return df.join(resolved, order, "left")
