"""Cleaning and scaling of price series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import nan_to_null, non_negative, numeric_columns, ratio
from tidemark.operators.series import KEYS, RN, Series, Step, compute, exact_quantiles, lay_out
from tidemark.session import staged

OHLCV = ("open", "high", "low", "close", "volume")
COIN = ("price", "volume", "market_cap")
#: Outlier z-score and replacement quantiles (low, high).
STOCK_OUTLIERS = (3.0, 0.05, 0.95)
CRYPTO_OUTLIERS = (4.0, 0.0025, 0.9975)
MIN_ROWS_FOR_OUTLIERS = 30


def coerce_dates(df: DataFrame, column: str = "date") -> tuple[DataFrame, DataFrame]:
    """Split into rows with a readable date and rows to quarantine."""
    from tidemark.functions.columns import to_day

    parsed = df.withColumn("_day", to_day(column))
    good = parsed.where("_day is not null").withColumn(column, F.col("_day")).drop("_day")
    return good, parsed.where("_day is null").drop("_day")


def dedupe_first(
    df: DataFrame, tie: Sequence[str], keys: Sequence[str] = KEYS, order: str = "date"
) -> DataFrame:
    """One row per (series, date): the first by ``tie``. Combines map-side, so copies are cheap."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    kept = df.groupBy(*keys, order).agg(F.min_by(F.struct(*rest), F.struct(*tie)).alias("_row"))
    return kept.select(*[F.col(c) if c in (*keys, order) else F.col(f"_row.{c}") for c in df.columns])


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns or numeric_columns(df)))


def _neighbours(s: Series, columns: Sequence[str]) -> tuple[Series, dict[str, tuple[Column, Column]]]:
    """Nearest present (row number, value) at or before, and at or after, each row."""
    present = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(RN).alias("rn"), F.col(c).alias("x"))) for c in columns}
    s = s.join_blocks(
        [agg(present[c]).alias(f"_{side}_{c}") for c in columns for side, agg in (("first", F.min), ("last", F.max))],
        lambda before, after: [
            side
            for c in columns
            for side in (
                F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_prev_{c}"),
                F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_next_{c}"),
            )
        ],
    )
    lo, hi = s.so_far(), s.so_far(backwards=True)
    s = s.add({
        name: value
        for c in columns
        for name, value in (
            (f"_prev_{c}", F.coalesce(F.last(present[c], ignorenulls=True).over(lo), F.col(f"_prev_{c}"))),
            (f"_next_{c}", F.coalesce(F.last(present[c], ignorenulls=True).over(hi), F.col(f"_next_{c}"))),
        )
    })
    return s, {c: (F.col(f"_prev_{c}"), F.col(f"_next_{c}")) for c in columns}


def _drop_neighbours(s: Series, columns: Sequence[str]) -> Series:
    return s.drop(*[f"_{side}_{c}" for c in columns for side in ("prev", "next")])


def interpolate(s: Series, columns: Sequence[str]) -> Series:
    """Linear by row position; leading and trailing gaps take the nearest value."""
    s, near = _neighbours(s, columns)
    filled = {}
    for c, (p, n) in near.items():
        share = ratio(F.col(RN) - p["rn"], n["rn"] - p["rn"])
        filled[c] = (
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(p.isNull(), n["x"])
            .when(n.isNull(), p["x"])
            .otherwise(p["x"] + (n["x"] - p["x"]) * share)
        )
    return _drop_neighbours(s.add(filled), columns)


def fill_forward(s: Series, columns: Sequence[str]) -> Series:
    """Last known value; a leading gap takes the first known one."""
    s, near = _neighbours(s, columns)
    return _drop_neighbours(s.add({c: F.coalesce(p["x"], n["x"]) for c, (p, n) in near.items()}), columns)


def winsorize(s: Series, columns: Sequence[str], rule: tuple[float, float, float]) -> Series:
    """Replace values beyond ``z`` population deviations by the low/high quantile of the series."""
    z, low, high = rule
    s = s.staged()
    rows = s.core()
    moments = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        moments += [F.avg(c).alias(f"_avg_{c}"), F.stddev_pop(c).alias(f"_dev_{c}")]
    bounds = exact_quantiles(rows, columns, (low, high), s.keys, s.order)
    stats = rows.groupBy(*s.keys).agg(*moments).join(bounds, [*s.keys], "left")
    s = s.join_per_series(stats)
    capped = {}
    for c in columns:
        x, lo, hi = F.col(c), F.col(f"{c}_q0"), F.col(f"{c}_q1")
        odd = (F.col("_rows") > MIN_ROWS_FOR_OUTLIERS) & (
            F.abs(ratio(x - F.col(f"_avg_{c}"), F.col(f"_dev_{c}"))) > z
        )
        capped[c] = F.when(odd & (x > hi), hi).when(odd & (x < lo), lo).otherwise(x)
    return s.add(capped).drop(
        "_rows", *[n for c in columns for n in (f"_avg_{c}", f"_dev_{c}", f"{c}_q0", f"{c}_q1")]
    )


def clamp(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: non_negative(c) for c in columns if c in df.columns})


def order_high_low(df: DataFrame) -> DataFrame:
    """Exchange high and low where they are the wrong way round."""
    wrong = F.col("high") < F.col("low")
    return df.withColumns({
        "high": F.when(wrong, F.col("low")).otherwise(F.col("high")),
        "low": F.when(wrong, F.col("high")).otherwise(F.col("low")),
    })


def _clean(df, columns, rule, missing, outliers, tie, keys, order, block_rows) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    out = staged(dedupe_first(nan_to_null(df), tie, keys, order))
    if missing == "drop":
        out = drop_missing(out)
    s = lay_out(out, keys=keys, order=order, block_rows=block_rows)
    numeric = numeric_columns(out, without=tuple(tie) + tuple(keys))
    gaps = sorted(set(numeric) | set(present))
    if missing == "interpolate":
        s = interpolate(s, gaps)
    elif missing == "forward":
        s = fill_forward(s, gaps)
    elif missing != "drop":
        raise ValueError(f"missing must be drop, interpolate or forward, not {missing}")
    if outliers:
        s = winsorize(s, present, rule)
    return s.rows()


def clean_stock_data(
    df: DataFrame, missing: str = "interpolate", outliers: bool = True, tie: Sequence[str] = ("close",),
    keys: Sequence[str] = KEYS, order: str = "date", block_rows: int | None = None,
) -> DataFrame:
    """De-duplicate, fill gaps, tame outliers, then make volume and high/low sane."""
    out = _clean(df, OHLCV, STOCK_OUTLIERS, missing, outliers, tie, keys, order, block_rows)
    return order_high_low(clamp(out, ("volume",)))


def clean_crypto_data(
    df: DataFrame, missing: str = "interpolate", outliers: bool = True, tie: Sequence[str] = ("price",),
    keys: Sequence[str] = KEYS, order: str = "date", block_rows: int | None = None,
) -> DataFrame:
    out = _clean(df, COIN, CRYPTO_OUTLIERS, missing, outliers, tie, keys, order, block_rows)
    return clamp(out, COIN)


# -- scaling -------------------------------------------------------------------------------------


def scale_minmax(df: DataFrame, columns: Sequence[str], keys=KEYS, order="date", block_rows=None) -> DataFrame:
    """To [0, 1] per series; a constant series becomes 0."""
    s = lay_out(df, keys=keys, order=order, block_rows=block_rows).join_series(
        *[agg(c).alias(f"_{n}_{c}") for c in columns for n, agg in (("lo", F.min), ("hi", F.max))]
    )
    s = s.add({
        c: F.when(F.col(c).isNotNull(), F.coalesce(
            ratio(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")), F.lit(0.0)))
        for c in columns
    })
    return s.drop(*[f"_{n}_{c}" for c in columns for n in ("lo", "hi")]).rows()


def scale_standard(df: DataFrame, columns: Sequence[str], keys=KEYS, order="date", block_rows=None) -> DataFrame:
    """Zero mean, unit population deviation per series; a constant series becomes 0."""
    s = lay_out(df, keys=keys, order=order, block_rows=block_rows).join_series(
        *[agg(c).alias(f"_{n}_{c}") for c in columns for n, agg in (("avg", F.avg), ("dev", F.stddev_pop))]
    )
    s = s.add({
        c: F.when(F.col(c).isNotNull(), F.coalesce(
            ratio(F.col(c) - F.col(f"_avg_{c}"), F.col(f"_dev_{c}")), F.lit(0.0)))
        for c in columns
    })
    return s.drop(*[f"_{n}_{c}" for c in columns for n in ("avg", "dev")]).rows()


def scale_log(df: DataFrame, columns: Sequence[str], margin: float = 1.0, keys=KEYS, order="date", block_rows=None) -> DataFrame:
    """Natural log; a series with values ≤ 0 is first shifted by |min| + ``margin``.

    ``margin`` is 1 for stocks and 1e-6 for coins.
    """
    s = lay_out(df, keys=keys, order=order, block_rows=block_rows).join_series(
        *[F.min(c).alias(f"_lo_{c}") for c in columns]
    )
    s = s.add({
        c: F.log(F.when(F.col(f"_lo_{c}") <= 0, F.col(c) + F.abs(f"_lo_{c}") + margin).otherwise(F.col(c)))
        for c in columns
    })
    return s.drop(*[f"_lo_{c}" for c in columns]).rows()


def percent_change(df: DataFrame, columns: Sequence[str], keys=KEYS, order="date", block_rows=None) -> DataFrame:
    """Adds ``<column>_pct_change`` and drops each series' first row."""
    step = Step(
        lambda s: s.add({f"{c}_pct_change": (ratio(F.col(c), s.lag(c)) - 1) * 100 for c in columns}), back=1
    )
    return compute(df, step, keys=keys, order=order, block_rows=block_rows, keep_ordinal="_n").where("_n > 1").drop("_n")


def normalize(df: DataFrame, method: str, columns: Sequence[str] | None = None, log_margin: float = 1.0, **layout) -> DataFrame:
    columns = list(columns or numeric_columns(df, without=("timestamp",)))
    if method == "minmax":
        return scale_minmax(df, columns, **layout)
    if method == "standard":
        return scale_standard(df, columns, **layout)
    if method == "log":
        return scale_log(df, columns, log_margin, **layout)
    if method == "percent":
        return percent_change(df, columns, **layout)
    raise ValueError(f"unknown method {method}")
