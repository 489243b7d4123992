"""Ranks inside groups of any size: no group has to be sorted in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

#: Buckets over which the rows of one value are spread.
SPREAD = 64


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, spread: str, out: str = "rank") -> DataFrame:
    """Add the rank of ``value`` among the rows with equal ``keys``: 1, 2, …, equal values at their mean rank.

    Values are counted first, so ties shrink to a row. The counted values are dealt by range of (keys, value): a large group
    fills many ranges, and inside one a running sum gives the rank, to which the ranges before add their totals, one
    small row each. Ranks go back to the rows by (keys, value, bucket of the ``spread`` column), so a value that most
    rows share is joined in many tasks. Values are not NULL.
    """
    keys = list(keys)
    rows = df.withColumn("_spread", F.pmod(F.xxhash64(spread), F.lit(SPREAD)).cast("int"))
    counted = rows.groupBy(*keys, value, "_spread").agg(F.count(F.lit(1)).alias("_c"))
    counted = staged(counted)
    ties = counted.groupBy(*keys, value).agg(F.sum("_c").alias("_ties"))
    dealt = staged(ties.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy(*keys, "_part").agg(F.sum("_ties").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range of a group
    offsets = parts.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.withColumn("_upto", F.sum("_ties").over(inside)).join(offsets, [*keys, "_part"])
    # of the places before + 1 … before + upto, the last ties ones belong to the value
    rank = F.col("_before") + F.col("_upto") - (F.col("_ties") - 1) / 2
    ranked = ranked.select(*keys, value, rank.cast("double").alias(out))
    spread_ranks = counted.select(*keys, value, "_spread").join(ranked, [*keys, value])
    return rows.join(spread_ranks, [*keys, value, "_spread"]).drop("_spread")
