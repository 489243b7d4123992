"""Statement items, amounts, repairs and ratios."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import amount, plain_symbol, stock_symbol
from tidemark.operators import company as co

ITEMS = {
    "income": (co.INCOME_ITEMS, {
        "Total Revenue": "total_revenue", "REVENUE": "revenue", "Sales, general and administrative": "revenue", "Cost of Revenue": "cost_of_revenue",
        "Cost of Goods Sold": "cost_of_revenue", "COGS": "cost_of_revenue", "Gross Profit": "gross_profit", "Operating Expenses": "operating_expenses",
        "Total Operating Expenses": "total_operating_expenses", "Research & Development": "rd_expense", "R&D": "rd_expense",
        "Selling, General & Administrative": "sga_expense", "SGA": "sga_expense", "Operating Income": "operating_income", "Interest Expense": "interest_expense",
        "Income Tax": "income_tax", "Net Income": "net_income", "Earnings Per Share": "eps", "Diluted EPS": "diluted_eps", "EBITDA": "ebitda",
        "Dividends": "Dividends", "Other revenue": "Other revenue"}),
    "balance": (co.BALANCE_ITEMS, {
        "Total Assets": "total_assets", "Total current assets": "total_assets", "Current Assets": "current_assets", "Cash and Cash Equivalents": "cash_and_equivalents",
        "Cash": "cash_and_equivalents", "Short Term Investments": "short_term_investments", "Accounts Receivable": "accounts_receivable", "Inventory": "inventory",
        "Non-Current Assets": "non_current_assets", "Property, Plant & Equipment": "ppe", "PPE": "ppe", "Long Term Investments": "long_term_investments",
        "Goodwill": "goodwill", "Intangible Assets": "intangible_assets", "Total Liabilities": "total_liabilities", "Current Liabilities": "current_liabilities",
        "Accounts Payable": "accounts_payable", "Short-Term Debt": "short_term_debt", "Non-current Liabilities": "non_current_liabilities",
        "Long Term Debt": "long_term_debt", "Total Equity": "total_equity", "Stockholders Equity": "total_equity", "Common Stock": "common_stock",
        "Retained Earnings": "retained_earnings", "Treasury Stock": "treasury_stock", "Minority interest": "Minority interest"}),
}


@pytest.mark.parametrize("kind", ITEMS)
def test_items(spark, kind):
    names, want = ITEMS[kind]
    df = spark.createDataFrame([(k,) for k in want], "item string").select("item", co.canonical_item("item", names).alias("name"))
    assert {r.item: r.name for r in df.collect()} == want


def test_item_override(spark):
    df = spark.createDataFrame([("Sales, general",)], "item string")
    assert df.select(co.canonical_item("item", co.INCOME_ITEMS, {"sales, general": "sga_expense"})).first()[0] == "sga_expense"


def test_amounts(spark):
    cases = {"(1,234.5)": -1234.5, "$5%": 5.0, "-": None, "N/A": None, "": None, "1,234.56": 1234.56, "$1,234.56": 1234.56, "nan": None, "-3": -3.0}
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "t string").select("t", amount("t").alias("v"))
    assert {r.t: r.v for r in df.collect()} == {**cases, None: None}


def test_symbols(spark):
    df = spark.createDataFrame([("^gspc", True), ("gspc", True), ("aapl", False)], "s string, i boolean")
    assert [r[0] for r in df.select(stock_symbol("s", F.col("i"))).collect()] == ["^GSPC", "^GSPC", "AAPL"]
    assert df.select(plain_symbol(F.lit("^GsPc"))).first()[0] == "gspc"


def statement(spark, cells):
    rows = [("c", i, item, p, text) for i, (item, values) in enumerate(cells) for p, text in values.items()]
    return spark.createDataFrame(rows, "company string, line int, item string, period string, text string")


def test_sparse_period_goes_and_gaps_become_zero(spark):
    df = statement(spark, [("a", {"2020": "1", "2021": None}), ("b", {"2020": "N/A", "2021": "-"}), ("c", {"2020": "3", "2021": "x"}), ("d", {"2020": "4", "2021": "5"})])
    got = {(r.line, r.period): r.value for r in co.drop_sparse_periods(co.parse_statement(df, {"zzz": "zzz"})).collect()}
    assert got == {(0, "2020"): 1.0, (1, "2020"): 0.0, (2, "2020"): 3.0, (3, "2020"): 4.0}


def test_repairs_touch_only_the_first_line(spark):
    income = statement(spark, [("Revenue", {"Y1": "100", "Y2": "100"}), ("Cost of revenue", {"Y1": "40", "Y2": "40"}), ("Gross profit", {"Y1": "10", "Y2": "61"}), ("Gross profit", {"Y1": "1", "Y2": "1"})])
    got = {(r.line, r.period): r.value for r in co.clean_income_statement(income).where("item = 'gross_profit'").collect()}
    assert got == {(2, "y1"): 60.0, (2, "y2"): 61.0, (3, "y1"): 1.0, (3, "y2"): 1.0}
    balance = statement(spark, [("Total assets", {"Y1": "100"}), ("Total liabilities", {"Y1": "60"}), ("Total equity", {"Y1": "60"})])
    assert co.clean_balance_sheet(balance).where("item = 'total_assets'").first().value == 120.0
    partial = statement(spark, [("Total assets", {"Y1": "100"}), ("Total liabilities", {"Y1": "60"})])
    assert co.clean_balance_sheet(partial).where("item = 'total_assets'").first().value == 100.0


def test_ratios(spark):
    income = co.clean_income_statement(statement(spark, [("Revenue", {"Y1": "0"}), ("Total revenue", {"Y1": "200"}), ("Cost of revenue", {"Y1": "50"}), ("Operating income", {"Y1": "30"}), ("Interest expense", {"Y1": "-10"})]))
    balance = co.clean_balance_sheet(statement(spark, [("Current assets", {"Y1": "80", "Y2": "1"}), ("Inventory", {"Y1": "20", "Y2": "1"}), ("Current liabilities", {"Y1": "40", "Y2": "1"})]))
    got = {r.ratio: r.value for r in co.financial_ratios(income, balance).collect()}
    assert got == {"Gross_Margin": 75.0, "Operating_Margin": 15.0, "Net_Margin": 0.0, "Current_Ratio": 2.0, "Quick_Ratio": 1.5, "Cash_Ratio": 0.0,
                   "Inventory_Turnover": 2.5, "Interest_Coverage": 3.0}
    assert co.financial_ratios(income, balance, ["Y9"]).count() == 0


def test_ratio_document_drops_empty_ratios(spark):
    rows = [("c", "S", "r", "-1", "(2.5)"), ("c", "S", "r", "-2", "N/A"), ("c", "S", "gone", "-1", "-"), ("c", "T", "gone", "-1", None)]
    got = co.normalize_ratios(spark.createDataFrame(rows, "company string, section string, ratio string, period string, text string")).collect()
    assert sorted((r.ratio, r.period, r.value) for r in got) == sorted([("r", "-1", -2.5), ("r", "-2", None)], key=str)
