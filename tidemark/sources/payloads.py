"""Rows from landed API payloads. Each function takes a DataFrame with the raw text in ``payload``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas

#: Well-known coin symbols and their ids, which win over the listing.
COIN_IDS = {
    "btc": "bitcoin",
    "eth": "ethereum",
    "usdt": "tether",
    "bnb": "binancecoin",
    "sol": "solana",
    "xrp": "ripple",
    "usdc": "usd-coin",
    "ada": "cardano",
    "doge": "dogecoin",
    "dot": "polkadot",
}
#: Display names of the main indices.
INDEX_NAMES = {
    "^GSPC": "S&P 500",
    "^DJI": "Dow Jones Industrial Average",
    "^IXIC": "NASDAQ Composite",
    "^NYA": "NYSE Composite",
    "^RUT": "Russell 2000",
    "^VIX": "CBOE Volatility Index",
    "^FTSE": "FTSE 100",
    "^N225": "Nikkei 225",
    "^HSI": "Hang Seng Index",
    "^GDAXI": "DAX",
}


def look_up(column: str | Column, table: Mapping[str, str]) -> Column:
    """Value of a short fixed table, NULL if absent."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(column) if isinstance(column, str) else column)


def coin_id(df: DataFrame, listing: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Adds ``coin_id``: the fixed table first, else the listing's exact symbol match (first id)."""
    known = listing.groupBy(F.lower("symbol").alias("_s")).agg(F.min("id").alias("_listed"))
    out = df.withColumn("_s", F.lower(symbol)).join(known, "_s", "left")
    return out.withColumn("coin_id", F.coalesce(look_up("_s", COIN_IDS), "_listed")).drop("_s", "_listed")


def bars(df: DataFrame, keys: Sequence[str] = ("symbol",), intraday: bool = False) -> DataFrame:
    """``{"2024-01-02": {"1. open": "…"}}`` or capitalised names, to one bar per entry."""
    parsed = df.select(*keys, F.explode(F.from_json("payload", schemas.BAR_PAYLOAD)).alias("_at", "_bar"))
    plain = F.transform_keys("_bar", lambda k, _: F.regexp_replace(F.regexp_replace(F.lower(k), r"^\d+\. ", ""), " ", "_"))
    parsed = parsed.withColumn("_bar", plain)
    at = F.try_to_timestamp("_at")
    names = ["open", "high", "low", "close", "volume"] + ([] if intraday else ["adjusted_close"])
    when = at.alias("datetime") if intraday else F.to_date(at).alias("date")
    return parsed.select(*keys, when, *[F.try_element_at("_bar", F.lit(n)).try_cast("double").alias(n) for n in names])


def reports(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Annual and quarterly reports in one table, tagged ``reportType``; fields stay a map."""
    parsed = df.select(*keys, F.from_json("payload", schemas.REPORTS_PAYLOAD).alias("_p"))
    parts = [
        parsed.select(*keys, F.lit(kind).alias("reportType"), F.explode(f"_p.{field}").alias("fields"))
        for kind, field in (("annual", "annualReports"), ("quarterly", "quarterlyReports"))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def report_columns(df: DataFrame, names: Sequence[str], text: Sequence[str] = ("fiscalDateEnding", "reportedCurrency")) -> DataFrame:
    """Pick fields out of the map: numbers, or text for those in ``text``."""
    value = lambda n: F.try_element_at("fields", F.lit(n))
    return df.select(*[c for c in df.columns if c != "fields"], *[
        (value(n) if n in text else value(n).try_cast("double")).alias(n) for n in names])


def _series(column: Column) -> Column:
    """``[[t, x], …]`` as a map; of repeated times the last wins (``mapKeyDedupPolicy``)."""
    return F.map_from_entries(F.transform(column, lambda e: F.struct(e[0].cast("bigint"), e[1])))


def chart(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Price points with market cap and volume of the same millisecond, matched inside the row."""
    parsed = df.select(*keys, F.from_json("payload", schemas.CHART_PAYLOAD).alias("_p")).select(
        *keys, F.explode("_p.prices").alias("_e"), _series(F.col("_p.market_caps")).alias("_caps"), _series(F.col("_p.total_volumes")).alias("_vols"))
    at = F.col("_e")[0].cast("bigint")
    return parsed.select(
        *keys, F.to_date(F.timestamp_millis(at)).alias("date"), at.alias("timestamp"), F.col("_e")[1].alias("price"),
        F.try_element_at("_caps", at).alias("market_cap"), F.try_element_at("_vols", at).alias("volume"))


def fallback_series(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """The second provider's bars in the schema of :func:`chart`, plus OHL and ``volume_to``."""
    rows = df.select(*keys, F.explode(F.from_json("payload", schemas.FALLBACK_PAYLOAD)["Data"]["Data"]).alias("e"))
    return rows.select(
        *keys, F.to_date(F.timestamp_seconds("e.time")).alias("date"), F.col("e.time").alias("timestamp"), F.col("e.open").alias("open"),
        F.col("e.high").alias("high"), F.col("e.low").alias("low"), F.col("e.close").alias("price"),
        F.col("e.volumefrom").alias("volume"), F.col("e.volumeto").alias("volume_to"))


def coin_info(df: DataFrame, currency: str = "usd", keys: Sequence[str] = ()) -> DataFrame:
    """Flat coin description with defaults for missing text and lists."""
    p = df.select(*keys, F.from_json("payload", schemas.COIN_PAYLOAD).alias("p"))
    text = lambda c: F.coalesce(F.col(f"p.{c}"), F.lit(""))
    money = lambda c: F.try_element_at(F.col(f"p.market_data.{c}"), F.lit(currency)).alias(c)
    return p.select(
        *keys, text("id").alias("id"), F.upper(text("symbol")).alias("symbol"), text("name").alias("name"),
        F.coalesce("p.categories", F.array().cast("array<string>")).alias("categories"),
        F.coalesce(F.try_element_at("p.description", F.lit("en")), F.lit("")).alias("description"),
        "p.market_cap_rank", "p.hashing_algorithm", "p.genesis_date", *[money(c) for c in ("current_price", "market_cap", "total_volume")],
        *[F.col(f"p.market_data.{c}").alias(c) for c in ("circulating_supply", "total_supply", "max_supply")],
        *[F.col(f"p.market_data.price_change_percentage_{d}").alias(f"price_change_{d}") for d in ("24h", "7d", "30d")])


def coin_network(info: DataFrame, blocks: DataFrame) -> DataFrame:
    """Supply fields of :func:`coin_info` with the block metrics landed for the same symbol, if any."""
    base = info.select("symbol", "hashing_algorithm", "genesis_date", "circulating_supply", "total_supply", "max_supply")
    extra = blocks.select(F.upper("symbol").alias("symbol"), F.from_json("payload", schemas.BLOCK_PAYLOAD).alias("b")).select("symbol", "b.*")
    return base.join(extra, "symbol", "left")


def global_market(df: DataFrame, currency: str = "usd") -> DataFrame:
    """Total market cap per date from a global document with parallel lists; lists of unequal length give nothing."""
    p = df.select(F.from_json("payload", schemas.GLOBAL_PAYLOAD).alias("p"))
    both = F.arrays_zip(F.col("p.date").alias("d"), F.try_element_at("p.total_market_cap", F.lit(currency)).alias("v"))
    equal = F.size("p.date") == F.size(F.try_element_at("p.total_market_cap", F.lit(currency)))
    return p.where(equal).select(F.explode(both).alias("e")).select(F.to_date("e.d").alias("date"), F.col("e.v").alias("total_market_cap"))


def ratio_document(df: DataFrame, keys: Sequence[str] = ("company",)) -> DataFrame:
    """``{section: {ratio: {period: value}}}`` to ``(…, section, ratio, period, text)``."""
    a = df.select(*keys, F.explode(F.from_json("payload", schemas.RATIO_PAYLOAD)).alias("section", "_r"))
    b = a.select(*keys, "section", F.explode("_r").alias("ratio", "_v"))
    return b.select(*keys, "section", "ratio", F.explode("_v").alias("period", "text"))


#: The per-class blocks of a correlation document.
MATRIX_BLOCKS = (
    "stocks_vs_crypto", "stocks_vs_indices", "crypto_vs_indices",
    "intra_stock_corr", "intra_crypto_corr", "intra_indices_corr", "global_correlation",
)


def matrix_pairs(df: DataFrame, matrix: str, keys: Sequence[str]) -> DataFrame:
    """Nested map to one row per pair, names in order; square matrices and rectangular ones alike.

    Where both halves of a square matrix are given, the entry whose row comes first by name counts.
    """
    rows = df.select(*keys, F.explode(matrix).alias("symbol_1", "_m")).select(*keys, "symbol_1", F.explode("_m").alias("symbol_2", "corr"))
    return one_per_pair(rows, keys)


def one_per_pair(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matrix entries ``(…, symbol_1, symbol_2, corr)`` to one row per unordered pair, without the diagonal."""
    known = rows.where("symbol_1 <> symbol_2 and corr is not null and not isnan(corr)")
    a, b = F.least("symbol_1", "symbol_2"), F.greatest("symbol_1", "symbol_2")
    return known.groupBy(*keys, a.alias("_a"), b.alias("_b")).agg(F.min_by("corr", "symbol_1").alias("corr")).select(
        *keys, F.col("_a").alias("symbol_1"), F.col("_b").alias("symbol_2"), "corr")


def correlation_documents(df: DataFrame) -> DataFrame:
    """All three layouts: one matrix, a matrix per class pair, and rolling series per ``a_b`` pair.

    Gives ``(symbol_1, symbol_2, calc_date, time_window, corr)``. A document without a date takes
    the ``landed`` column if there is one.
    """
    blocks = ", ".join(f"{b}:struct<matrix:{schemas.MATRIX}>" for b in MATRIX_BLOCKS)
    layout = (f"struct<calc_date:string,time_window:string,matrix:{schemas.MATRIX},{blocks},"
              "rolling_correlations:map<string,array<struct<date:string,correlation:double>>>>")
    landed = F.col("landed") if "landed" in df.columns else F.lit(None).cast("date")
    p = df.select(F.from_json("payload", layout).alias("p"), landed.alias("_landed"))
    day = F.coalesce(F.to_date(F.try_to_timestamp("p.calc_date")), "_landed").alias("calc_date")
    single = p.select(day, F.coalesce("p.time_window", F.lit("custom")).alias("time_window"), F.col("p.matrix").alias("m")).where("m is not null")
    each = F.array(*[F.struct(F.lit(f"{b}_custom").alias("time_window"), F.col(f"p.{b}.matrix").alias("m")) for b in MATRIX_BLOCKS])
    classes = p.select(day, F.explode(each).alias("e")).select("calc_date", "e.time_window", "e.m").where("m is not null")
    series = p.select(F.explode("p.rolling_correlations").alias("pair", "s")).select(F.split("pair", "_").alias("ab"), F.explode("s").alias("e"))
    rolling = series.where("size(ab) = 2 and e.correlation is not null").select(
        F.col("ab")[0].alias("symbol_1"), F.col("ab")[1].alias("symbol_2"), F.to_date(F.try_to_timestamp("e.date")).alias("calc_date"),
        F.lit("rolling_30d").alias("time_window"), F.col("e.correlation").alias("corr"))
    matrices = matrix_pairs(single.unionByName(classes), "m", ["calc_date", "time_window"])
    return matrices.select(*rolling.columns).unionByName(rolling)
