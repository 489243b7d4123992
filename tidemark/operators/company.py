"""Company statements in long form: ``(company, line, item, period, text)`` and what follows from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import amount, null_if_nan, ratio
from tidemark.session import staged

#: Statement item patterns and their canonical names, in matching order.
INCOME_ITEMS = {
    "total.*revenue": "total_revenue",
    "revenue": "revenue",
    "sales": "revenue",
    "cost.*revenue": "cost_of_revenue",
    "cost.*goods.*sold": "cost_of_revenue",
    "cogs": "cost_of_revenue",
    "gross.*profit": "gross_profit",
    "operating.*expenses": "operating_expenses",
    "total.*operating.*expenses": "total_operating_expenses",
    "research.*development": "rd_expense",
    "r&d": "rd_expense",
    "selling.*general.*administrative": "sga_expense",
    "sga": "sga_expense",
    "operating.*income": "operating_income",
    "interest.*expense": "interest_expense",
    "income.*tax": "income_tax",
    "net.*income": "net_income",
    "earnings.*per.*share": "eps",
    "diluted.*eps": "diluted_eps",
    "ebitda": "ebitda",
}
BALANCE_ITEMS = {
    "total.*assets": "total_assets",
    "current.*assets": "current_assets",
    "cash.*equivalents": "cash_and_equivalents",
    "cash": "cash_and_equivalents",
    "short.*term.*investments": "short_term_investments",
    "accounts.*receivable": "accounts_receivable",
    "inventory": "inventory",
    "non.*current.*assets": "non_current_assets",
    "property.*plant.*equipment": "ppe",
    "ppe": "ppe",
    "long.*term.*investments": "long_term_investments",
    "goodwill": "goodwill",
    "intangible.*assets": "intangible_assets",
    "total.*liabilities": "total_liabilities",
    "current.*liabilities": "current_liabilities",
    "accounts.*payable": "accounts_payable",
    "short.*term.*debt": "short_term_debt",
    "non.*current.*liabilities": "non_current_liabilities",
    "long.*term.*debt": "long_term_debt",
    "total.*equity": "total_equity",
    "stockholders.*equity": "total_equity",
    "common.*stock": "common_stock",
    "retained.*earnings": "retained_earnings",
    "treasury.*stock": "treasury_stock",
}
SPARSE = 0.7
TOLERANCE = 0.1
STATEMENT = ("company", "period")


def canonical_item(item: str | Column, names: Mapping[str, str], overrides: Mapping[str, str] | None = None) -> Column:
    """Canonical name of the first pattern that matches at the start, any case; else the item itself.

    ``overrides`` are tried first: e.g. "Sales, general and administrative" counts as revenue by
    the standard table.
    """
    c = F.col(item) if isinstance(item, str) else item
    out = None
    for pattern, name in {**(overrides or {}), **names}.items():
        test = c.rlike(f"(?i)^(?:{pattern})")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(c)


def parse_statement(df: DataFrame, names: Mapping[str, str], overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical items and numeric values from statement text."""
    return df.withColumns({"item": canonical_item("item", names, overrides), "period": F.lower("period"), "value": amount("text")}).drop("text")


def _first(item: str) -> Column:
    """Value of the statement's first line with this item."""
    return F.min_by(F.col("value"), F.when(F.col("item") == item, F.col("line")))


def _with_facts(df: DataFrame, *facts: Column) -> DataFrame:
    """Add per-(company, period) aggregates to the lines: combined map-side, one small row joined back."""
    return df.join(df.groupBy(*STATEMENT).agg(*facts), [*STATEMENT])


def drop_sparse_periods(df: DataFrame) -> DataFrame:
    """Remove a company's periods with more than 70 % missing values; other gaps become 0."""
    missing = F.avg(F.col("value").isNull().cast("double")).alias("_missing")
    kept = _with_facts(df, missing).where(F.col("_missing") <= SPARSE).drop("_missing")
    return kept.withColumn("value", F.coalesce("value", F.lit(0.0))).select(*df.columns)


def _restate(df: DataFrame, needed: Sequence[str], target: str, expected: Column, reference: Column) -> DataFrame:
    """Replace the first ``target`` line by ``expected`` where they differ by over 10 % of ``reference``."""
    line = F.min(F.when(F.col("item") == target, F.col("line"))).alias("_line")
    out = _with_facts(df, line, *[_first(i).alias(f"_{i}") for i in needed])
    off = F.abs(expected - F.col(f"_{target}")) > TOLERANCE * F.abs(reference)
    fix = (F.col("item") == target) & (F.col("line") == F.col("_line")) & off
    return out.withColumn("value", F.when(fix, expected).otherwise(F.col("value"))).select(*df.columns)


def fix_gross_profit(df: DataFrame) -> DataFrame:
    expected = F.col("_revenue") - F.col("_cost_of_revenue")
    return _restate(df, ("revenue", "cost_of_revenue", "gross_profit"), "gross_profit", expected, expected)


def fix_total_assets(df: DataFrame) -> DataFrame:
    expected = F.col("_total_liabilities") + F.col("_total_equity")
    return _restate(df, ("total_assets", "total_liabilities", "total_equity"), "total_assets", expected, F.col("_total_assets"))


def clean_income_statement(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    return fix_gross_profit(drop_sparse_periods(staged(parse_statement(df, INCOME_ITEMS, overrides))))


def clean_balance_sheet(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    return fix_total_assets(drop_sparse_periods(staged(parse_statement(df, BALANCE_ITEMS, overrides))))


# -- ratios --------------------------------------------------------------------------------------

_INCOME_USED = ("revenue", "total_revenue", "cost_of_revenue", "operating_income", "net_income", "interest_expense")
_BALANCE_USED = ("total_assets", "total_equity", "current_assets", "current_liabilities", "inventory", "cash_and_equivalents",
                 "accounts_receivable", "short_term_debt", "long_term_debt")


def _items_wide(df: DataFrame, items: Sequence[str]) -> DataFrame:
    """One row per company and period with the first value of each item, 0 where it has none."""
    return df.groupBy(*STATEMENT).agg(*[F.coalesce(_first(i), F.lit(0.0)).alias(i) for i in items])


def financial_ratios(income: DataFrame, balance: DataFrame, periods: Sequence[str] | None = None) -> DataFrame:
    """Fourteen ratios per company and common period, long: ``(company, period, section, ratio, value)``.

    A ratio with a zero denominator is left out.
    """
    if periods is not None:
        income, balance = (d.where(F.col("period").isin([p.lower() for p in periods])) for d in (income, balance))
    wide = _items_wide(income, _INCOME_USED).join(_items_wide(balance, _BALANCE_USED), [*STATEMENT])
    c = F.col
    revenue = F.when(c("revenue") != 0, c("revenue")).otherwise(c("total_revenue"))
    debt = c("short_term_debt") + c("long_term_debt")
    values = {
        "Profitability_Ratios": {
            "Gross_Margin": ratio(revenue - c("cost_of_revenue"), revenue) * 100,
            "Operating_Margin": ratio(c("operating_income"), revenue) * 100,
            "Net_Margin": ratio(c("net_income"), revenue) * 100,
            "ROA": ratio(c("net_income"), c("total_assets")) * 100,
            "ROE": ratio(c("net_income"), c("total_equity")) * 100,
        },
        "Liquidity_Ratios": {
            "Current_Ratio": ratio(c("current_assets"), c("current_liabilities")),
            "Quick_Ratio": ratio(c("current_assets") - c("inventory"), c("current_liabilities")),
            "Cash_Ratio": ratio(c("cash_and_equivalents"), c("current_liabilities")),
        },
        "Efficiency_Ratios": {
            "Asset_Turnover": ratio(revenue, c("total_assets")),
            "Inventory_Turnover": ratio(c("cost_of_revenue"), c("inventory")),
            "Receivables_Turnover": ratio(revenue, c("accounts_receivable")),
        },
        "Solvency_Ratios": {
            "Debt_to_Equity": ratio(debt, c("total_equity")),
            "Debt_Ratio": ratio(debt, c("total_assets")),
            "Interest_Coverage": ratio(c("operating_income"), F.abs("interest_expense")),
        },
    }
    rows = F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(name).alias("ratio"), value.alias("value"))
        for section, named in values.items() for name, value in named.items()])
    return wide.select(*STATEMENT, F.explode(rows).alias("r")).select(*STATEMENT, "r.*").where("value is not null")


def normalize_ratios(df: DataFrame) -> DataFrame:
    """Numbers of a long ratio document ``(company, section, ratio, period, text)``; all-NULL ratios go."""
    text = F.when(F.col("text").isin("N/A", "-"), None).otherwise(F.col("text"))
    parsed = df.withColumn("value", null_if_nan(amount(text))).drop("text")
    known = parsed.groupBy("company", "section", "ratio").agg(F.count("value").alias("_known")).where("_known > 0")
    return parsed.join(known, ["company", "section", "ratio"], "left_semi")
