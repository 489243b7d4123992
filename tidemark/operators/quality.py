"""Quality gates: one verdict row per series or company. All are single partial-aggregated passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import KEYS


def _nulls(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def bar_gate(df: DataFrame, expected: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Missing columns fail; NULLs only warn."""
    lacking = [c for c in expected if c not in df.columns]
    present = [c for c in expected if c in df.columns]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *_nulls(present))
    total = sum((F.col(f"null_{c}") for c in present), F.lit(0))
    return out.withColumns({
        "valid": F.lit(not lacking), "verdict": F.lit("missing columns") if lacking else F.when(total > 0, "nulls").otherwise("ok")})


def coin_gate(df: DataFrame, required: Sequence[str], min_rows: int = 5, keys: Sequence[str] = KEYS) -> DataFrame:
    """At least ``min_rows`` rows and no required column more than half NULL."""
    lacking = [c for c in required if c not in df.columns]
    present = [c for c in required if c in df.columns]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *_nulls(present))
    worst = F.greatest(F.lit(0.0), F.lit(0.0), *[F.col(f"null_{c}") / F.col("rows") for c in present])
    verdict = (
        F.lit("missing columns") if lacking
        else F.when(F.col("rows") < min_rows, "too few rows").when(worst > 0.5, "too many nulls").otherwise("ok"))
    return out.withColumn("verdict", verdict).withColumn("valid", F.col("verdict") == "ok")


def statement_gate(df: DataFrame, min_columns: int = 3, min_rows: int = 5) -> DataFrame:
    """Long statements: enough periods (plus the item column) and items, at most half of all cells NULL."""
    out = df.groupBy("company").agg(
        (F.countDistinct("period") + 1).alias("columns"), F.countDistinct("line").alias("rows"),
        F.count(F.lit(1)).alias("_cells"), F.count_if(F.col("text").isNull() | F.col("text").isin("", "N/A")).alias("_null"))
    share = F.col("_null") / (F.col("_cells") + F.col("rows"))  # item cells count as filled
    verdict = (
        F.when(F.col("columns") < min_columns, "too few columns").when(F.col("rows") < min_rows, "too few rows")
        .when(share > 0.5, "too many nulls").otherwise("ok"))
    return out.select("company", "columns", "rows", share.alias("null_share"), verdict.alias("verdict"))


def split_by_history(df: DataFrame, least: int, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Series with at least ``least`` rows, and the skipped ones with the reason."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    enough = df.join(sizes.where(F.col("rows") >= least).select(*keys), [*keys], "left_semi")
    return enough, sizes.where(F.col("rows") < least).withColumn("reason", F.lit(f"fewer than {least} rows"))
