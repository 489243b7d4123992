"""Gapless numbering of a whole table in a given order, without a window over all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

#: Bits that ``monotonically_increasing_id`` leaves to the row inside its partition.
ROW_BITS = 33


def in_order(df: DataFrame, by: Sequence[Column], name: str = "ordinal", part: str = "part") -> DataFrame:
    """Add ``name`` (0, 1, 2, … in the given order) and ``part`` (the range partition a row was sorted in).

    Rows are written once, dealt by range and sorted inside their range, then written again; a row's number is its
    place in its range plus the rows of the ranges before it. A hot key is split over as many ranges as it fills,
    equal rows too: they are told apart by where they stood first. Only one row per range is broadcast. All that later
    steps read is on disk, so a lost executor cannot change a number.
    """
    first = staged(df.withColumn("_tie", F.monotonically_increasing_id()))
    order = [*by, F.col("_tie")]
    dealt = staged(first.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn(part, F.shiftright("_at", ROW_BITS).cast("int"))
    sizes = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return dealt.join(F.broadcast(starts), part).withColumn(name, F.col("_start") + inside).drop("_at", "_start")
