"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` edges; ``root`` is the smallest node that can be reached.

    Each round hangs every node's neighbours, and the node itself, under the smallest of them, in alternation
    for all and for the smaller neighbours only; the number of rounds grows with the logarithm of the longest
    path. Rounds are written to the shared folder, so lineage stays short; a hub's many edges only meet in
    aggregates that combine before the shuffle and in joins that adaptive execution may split. Edges that are
    stars already take no round, as every round costs the driver a dozen stages with a broadcast each.
    """
    links = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(links):
        # Larger neighbours go to the smallest neighbour (or the node itself).
        low = _ends(links, ("a", "b"), ("b", "a")).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = links.select(F.col("b").alias("n"), F.col("a").alias("x")).join(low.withColumnRenamed("a", "n"), "n").select(F.col("x").alias("a"), F.col("m").alias("b"))
        large = staged(large.filter("a <> b").distinct())
        # Smaller neighbours, and the node, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        links = staged(small.filter("a <> b").distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _ends(links: DataFrame, *sides: tuple[str, str]) -> DataFrame:
    """A row ``a, b`` per edge and side; one scan."""
    return links.select(F.explode(F.array(*[F.struct(F.expr(x).alias("a"), F.expr(y).alias("b")) for x, y in sides])).alias("e")).select("e.*")


def _stars(links: DataFrame) -> bool:
    """Whether every node has one parent at most, and no parent has one."""
    ends = _ends(links, ("a", "1L"), ("b", "0L")).groupBy("a").agg((F.sum("b") + F.max(1 - F.col("b"))).alias("n"))  # parents, and 1 for being one
    return (ends.agg(F.max("n")).first()[0] or 0) <= 1
