"""Idempotent loads: a load is one key join, not a lookup per record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import numeric_columns

STOCK_COLUMNS = {"date": "trade_date", "open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}
COIN_COLUMNS = {"date": "trade_date", "price": "price_usd", "volume": "volume_24h"}

#: Aliases of network fields, weakest first; the canonical name beats them all.
NETWORK_ALIASES = {
    "trade_date": ("date",),
    "hashrate": ("hash_rate", "hashRate"),
    "active_addresses": ("active_wallets", "active_accounts"),
    "avg_transaction_fee": ("transaction_fee", "avg_fee"),
    "avg_transaction_value": ("transaction_value", "avg_value", "average_transaction_value"),
    "transaction_count": ("transactions", "tx_count"),
}
#: Columns that are indicators.
INDICATOR_PREFIXES = ("sma_", "ema_", "rsi_", "macd_", "bb_", "stoch_", "adx_", "atr_", "obv", "cci_", "mfi_", "roc_", "williams_r_", "ichimoku_")
STOCK_INDICATORS = ("daily_return", "cumulative_return", "volatility_20d", "trend_label")
COIN_INDICATORS = ("trend", "golden_cross", "death_cross", "log_return", "return_7d", "return_30d", "nvt_ratio", "nvt_signal",
                   "market_dominance", "market_cycle")


def latest(df: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """One row per key. Of several, each column takes its last known value by ``sequence``.

    Without a sequence there is no last one: records of one key that contradict each other then fail the
    job, while equal copies are one. Aggregates map-side, so many copies of one key cost little.
    """
    values = [c for c in df.columns if c not in keys and c != sequence]
    if sequence is None:
        agreed = lambda c: F.when(F.min(c).eqNullSafe(F.max(c)), F.max(c)).otherwise(
            F.raise_error(F.lit(f"several values of {c} for one key of {', '.join(keys)}; name a sequence column")))
        return df.groupBy(*keys).agg(*[agreed(c).alias(c) for c in values])
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(sequence))).alias(c) for c in values])


def merge(target: DataFrame, incoming: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """Target and incoming rows joined on the key, with ``action``.

    inserted: new key; updated: some supplied (non-NULL) value differs; ignored: nothing new;
    kept: only in the target. NULL never overwrites a value.
    """
    new = latest(incoming, keys, sequence)
    values = [c for c in target.columns if c not in keys]
    given = [c for c in values if c in new.columns]
    t, n = target.withColumn("_t", F.lit(True)).alias("t"), new.withColumn("_n", F.lit(True)).alias("n")
    same = None
    for k in keys:
        test = F.col(f"t.{k}") == F.col(f"n.{k}")
        same = test if same is None else same & test
    both = t.join(n, same, "full_outer")
    changed = F.lit(False)
    for c in given:
        changed = changed | (F.col(f"n.{c}").isNotNull() & ~F.col(f"n.{c}").eqNullSafe(F.col(f"t.{c}")))
    action = (
        F.when(F.col("_n").isNull(), "kept").when(F.col("_t").isNull(), "inserted").when(changed, "updated").otherwise("ignored"))
    return both.select(
        *[F.coalesce(f"t.{k}", f"n.{k}").alias(k) for k in keys],
        *[(F.coalesce(f"n.{c}", f"t.{c}") if c in given else F.col(f"t.{c}")).alias(c) for c in values],
        action.alias("action"))


def counts(merged: DataFrame) -> DataFrame:
    """``(action, records)`` without the rows the load did not touch."""
    return merged.where("action <> 'kept'").groupBy("action").agg(F.count(F.lit(1)).alias("records"))


# -- record shapes -------------------------------------------------------------------------------


def with_asset_id(df: DataFrame, assets: DataFrame, symbol: str = "symbol", out: str = "asset_id") -> tuple[DataFrame, DataFrame]:
    """Replace a symbol by its id; rows of unknown symbols come back separately."""
    ids = assets.select(F.col("symbol").alias(symbol), F.col("asset_id").alias(out))
    return df.join(ids, symbol).drop(symbol), df.join(ids, symbol, "left_anti")


def stock_price_rows(df: DataFrame) -> DataFrame:
    wanted = ("asset_id", "trade_date", "open_price", "high_price", "low_price", "close_price", "adjusted_close", "volume")
    named = df.withColumnsRenamed({k: v for k, v in STOCK_COLUMNS.items() if k in df.columns})
    return named.select(*[c for c in (*wanted, "seq") if c in named.columns])


def coin_market_rows(df: DataFrame) -> DataFrame:
    """Close stands in for a missing price column."""
    if "price" not in df.columns and "close" in df.columns:
        df = df.withColumn("price", F.col("close"))
    wanted = ("asset_id", "trade_date", "price_usd", "market_cap", "volume_24h", "circulating_supply", "total_supply", "price_change_24h")
    named = df.withColumnsRenamed({k: v for k, v in COIN_COLUMNS.items() if k in df.columns})
    return named.select(*[c for c in (*wanted, "seq") if c in named.columns])


def network_rows(df: DataFrame, keys: Sequence[str] = ("asset_id",)) -> DataFrame:
    """Canonical network columns: the canonical name beats aliases, a later alias an earlier one.

    Rows without a date are dropped.
    """
    out = []
    for name, aliases in NETWORK_ALIASES.items():
        found = [F.col(c) for c in (name, *reversed(aliases)) if c in df.columns]
        kind = "date" if name == "trade_date" else "double"
        out.append((F.coalesce(*found).cast(kind) if found else F.lit(None).cast(kind)).alias(name))
    return df.select(*keys, *out).where("trade_date is not null")


def indicator_columns(df: DataFrame, crypto: bool = False) -> list[str]:
    """Numeric columns named like an indicator."""
    numeric = numeric_columns(df)
    if crypto:
        return [c for c in numeric if c.startswith((*INDICATOR_PREFIXES, "volatility_")) or any(i in c for i in COIN_INDICATORS)]
    return [c for c in numeric if c.startswith(INDICATOR_PREFIXES) or c in STOCK_INDICATORS]


def indicator_rows(df: DataFrame, keys: Sequence[str] = ("asset_id",), crypto: bool = False) -> DataFrame:
    """Wide indicators to ``(…, calc_date, indicator_type, value, parameter1, parameter2)``; NULLs skipped.

    Parameters are the numbers right after the first word: ``macd_12_26_9`` gives 12 and 26.
    """
    chosen = indicator_columns(df, crypto)
    plain = df.select(*keys, F.col("date").alias("calc_date"), *[F.col(c).cast("double").alias(c) for c in chosen])
    long = plain.unpivot([*keys, "calc_date"], chosen, "indicator_type", "value").where("value is not null and not isnan(value)")
    digits = lambda pattern: F.regexp_extract("indicator_type", pattern, 1).try_cast("double")
    one, two = digits(r"^[^_]*_(\d+)(?:_|$)"), digits(r"^[^_]*_\d+_(\d+)(?:_|$)")
    return long.withColumns({"parameter1": one, "parameter2": two})


def correlation_rows(pairs: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long correlations ``(symbol_1, symbol_2, calc_date, time_window, corr)`` with ids; unknown symbols apart."""
    known, lost1 = with_asset_id(pairs.where("corr is not null"), assets, "symbol_1", "asset_id_1")
    known, lost2 = with_asset_id(known, assets, "symbol_2", "asset_id_2")
    rows = known.select("asset_id_1", "asset_id_2", "calc_date", "time_window", F.col("corr").alias("correlation_value"))
    return rows, lost1.select("symbol_1", "calc_date").withColumnRenamed("symbol_1", "symbol").unionByName(
        lost2.select("symbol_2", "calc_date").withColumnRenamed("symbol_2", "symbol"))


def register_assets(assets: DataFrame, incoming: DataFrame, buckets: int = 256) -> DataFrame:
    """Assets after registration, with ``action``; a new symbol gets the next free id.

    The name is always taken over; exchange, sector and industry only when given. New ids are
    numbered inside hash buckets whose sizes give the offsets, so no task numbers all symbols. Where the
    assets have ``created_at`` and ``updated_at``, a new asset gets both, a changed one the second.
    """
    cols = ("name", "asset_type", "exchange", "sector", "industry")
    new = incoming.groupBy("symbol").agg(*[F.max(c).alias(c) for c in cols if c in incoming.columns])
    lacking = {c: F.lit(None).cast("string") for c in cols if c not in new.columns}
    new = new.withColumns(lacking).withColumn("_n", F.lit(True)).alias("n")
    both = assets.withColumn("_t", F.lit(True)).alias("t").join(new, F.col("t.symbol") == F.col("n.symbol"), "full_outer")  # times come from the assets alone
    given = lambda c: F.when(F.col(f"n.{c}") != "", F.col(f"n.{c}"))
    name = F.coalesce("n.name", "t.name")
    changed = F.col("n.name").isNotNull() & (F.col("n.name") != F.col("t.name"))
    for c in ("exchange", "sector", "industry"):
        changed = changed | (given(c).isNotNull() & ~given(c).eqNullSafe(F.col(f"t.{c}")))
    action = F.when(F.col("_n").isNull(), "kept").when(F.col("_t").isNull(), "inserted").when(changed, "updated").otherwise("ignored")
    times = [c for c in ("created_at", "updated_at") if c in assets.columns]
    now = F.current_timestamp()
    stamped = {"created_at": F.coalesce("t.created_at", now), "updated_at": F.when(action.isin("inserted", "updated"), now).otherwise(F.col("t.updated_at"))}
    merged = both.select(
        "t.asset_id", F.coalesce("t.symbol", "n.symbol").alias("symbol"), name.alias("name"), F.coalesce("t.asset_type", "n.asset_type").alias("asset_type"),
        *[F.coalesce(given(c), F.col(f"t.{c}")).alias(c) for c in ("exchange", "sector", "industry")],
        *[stamped[c].alias(c) for c in times], action.alias("action"))
    fresh = merged.where("action = 'inserted'").withColumn("_b", F.pmod(F.xxhash64("symbol"), F.lit(buckets)))
    sizes = fresh.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    offsets = sizes.select("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))  # ≤ buckets rows
    top = assets.agg(F.coalesce(F.max("asset_id"), F.lit(0)).alias("m")).scalar()
    place = F.row_number().over(Window.partitionBy("_b").orderBy("symbol"))
    numbered = fresh.join(offsets, "_b").withColumn("asset_id", (top + F.col("_o") + place).cast("long"))
    return merged.where("action <> 'inserted'").unionByName(numbered.select(*merged.columns))
