"""All queries in one place."""

from __future__ import annotations

import importlib
from functools import wraps

from pyspark.sql import functions as F

from queries import adapters as a
from tidemark.operators import indicators as ind
from tidemark.operators import signals as sig
from tidemark.operators.series import compute
from tidemark.session import use_settings

MODULES = [importlib.import_module(f"queries.{m}") for m in ("prices", "correlations", "trends", "companies", "landing", "loads", "batches", "folders")]


def _with_settings(fn):
    @wraps(fn)
    def run(spark, folder):
        return fn(use_settings(spark), folder)

    return run


def queries():
    return {name: _with_settings(fn) for m in MODULES for name, fn in m.Q.items()}


def sql():
    return {name: text for m in MODULES for name, text in m.SQL.items()}


def flagship(spark, folder):
    out = compute(
        a.bars_daily(spark, folder),
        [ind.sma(20), ind.bollinger(20, pct_b="bb_pct_b_20")],
        sig.trend_label(),
    )
    return out.select("symbol", "date", "close", F.round("sma_20", 6).alias("sma_20"), "bb_high_20", "bb_low_20", "bb_pct_b_20", "trend_label")
