"""Statement and ratio queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import adapters as a
from tidemark.functions.columns import amount
from tidemark.operators import company as co

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def names_sql(names) -> str:
    return "case " + " ".join(f"when regexp_matches(item, '^(?:{p})', 'i') then '{n}'" for p, n in names.items()) + " else item end"


def parsed_sql(table: str, names, out: str) -> str:
    return f"{out} as (select company, line, {names_sql(names)} as item, period, value from {table})"


def dense_sql(source: str, out: str) -> str:
    return f"""{out} as (select company, line, item, period, coalesce(value, 0) as value from (select *,
  avg((value is null)::int) over (partition by company, period) as miss from {source}) where miss <= 0.7)"""


INC = f"{a.INCOME_RAW}, {parsed_sql('inc', co.INCOME_ITEMS, 'pinc')}, {dense_sql('pinc', 'dinc')}"
BAL = f"{a.BALANCE_RAW}, {parsed_sql('bal', co.BALANCE_ITEMS, 'pbal')}, {dense_sql('pbal', 'dbal')}"


def first_sql(item: str) -> str:
    return f"arg_min(value, line) filter (item = '{item}') over (partition by company, period)"


FIXED_INC = f"""cinc as (select company, line, item, period, case when item = 'gross_profit' and abs((rev - cost) - value) > 0.1 * abs(rev - cost) then rev - cost else value end as value
  from (select *, {first_sql('revenue')} as rev, {first_sql('cost_of_revenue')} as cost from dinc))"""
FIXED_BAL = f"""cbal as (select company, line, item, period, case when item = 'total_assets' and abs((li + eq) - value) > 0.1 * abs(value) then li + eq else value end as value
  from (select *, {first_sql('total_liabilities')} as li, {first_sql('total_equity')} as eq from dbal))"""
OUT = "select company, line, item, period, round(value, 2) as value from "


def shown(df):
    return df.select("company", "line", "item", "period", F.round("value", 2).alias("value"))


@query("canonical_items", f"""with {a.INCOME_RAW}, {a.BALANCE_RAW}, u as (select 'income' as statement, item, {names_sql(co.INCOME_ITEMS)} as canonical from inc
union all select 'balance', item, {names_sql(co.BALANCE_ITEMS)} from bal) select statement, item, canonical, count(*) as n from u group by 1, 2, 3""")
def canonical_items(spark, d):
    i = a.income_raw(spark, d).select(F.lit("income").alias("statement"), "item", co.canonical_item("item", co.INCOME_ITEMS).alias("canonical"))
    b = a.balance_raw(spark, d).select(F.lit("balance").alias("statement"), "item", co.canonical_item("item", co.BALANCE_ITEMS).alias("canonical"))
    return i.unionByName(b).groupBy("statement", "item", "canonical").agg(F.count(F.lit(1)).alias("n"))


@query("parse_amounts", f"with {a.INCOME_RAW} select company, line, item, period, value from inc")
def parse_amounts(spark, d):
    return a.income_raw(spark, d).select("company", "line", "item", "period", amount("text").alias("value"))


@query("drop_sparse_periods", f"with {INC} {OUT} dinc")
def drop_sparse_periods(spark, d):
    return shown(co.drop_sparse_periods(co.parse_statement(a.income_raw(spark, d), co.INCOME_ITEMS)))


@query("gross_profit_fix", f"with {INC}, {FIXED_INC} {OUT} cinc")
def gross_profit_fix(spark, d):
    return shown(co.clean_income_statement(a.income_raw(spark, d)))


@query("balance_identity_fix", f"with {BAL}, {FIXED_BAL} {OUT} cbal")
def balance_identity_fix(spark, d):
    return shown(co.clean_balance_sheet(a.balance_raw(spark, d)))


def item_sql(item: str) -> str:
    return f"coalesce(arg_min(value, line) filter (item = '{item}'), 0) as {item}"


RATIO_SQL = {
    ("Profitability_Ratios", "Gross_Margin"): "(r - cost_of_revenue) / nullif(r, 0) * 100", ("Profitability_Ratios", "Operating_Margin"): "operating_income / nullif(r, 0) * 100",
    ("Profitability_Ratios", "Net_Margin"): "net_income / nullif(r, 0) * 100", ("Profitability_Ratios", "ROA"): "net_income / nullif(total_assets, 0) * 100",
    ("Profitability_Ratios", "ROE"): "net_income / nullif(total_equity, 0) * 100", ("Liquidity_Ratios", "Current_Ratio"): "current_assets / nullif(current_liabilities, 0)",
    ("Liquidity_Ratios", "Quick_Ratio"): "(current_assets - inventory) / nullif(current_liabilities, 0)", ("Liquidity_Ratios", "Cash_Ratio"): "cash_and_equivalents / nullif(current_liabilities, 0)",
    ("Efficiency_Ratios", "Asset_Turnover"): "r / nullif(total_assets, 0)", ("Efficiency_Ratios", "Inventory_Turnover"): "cost_of_revenue / nullif(inventory, 0)",
    ("Efficiency_Ratios", "Receivables_Turnover"): "r / nullif(accounts_receivable, 0)", ("Solvency_Ratios", "Debt_to_Equity"): "debt / nullif(total_equity, 0)",
    ("Solvency_Ratios", "Debt_Ratio"): "debt / nullif(total_assets, 0)", ("Solvency_Ratios", "Interest_Coverage"): "operating_income / nullif(abs(interest_expense), 0)",
}
RATIOS = f"""{INC}, {FIXED_INC}, {BAL}, {FIXED_BAL},
iw as (select company, period, {', '.join(item_sql(i) for i in co._INCOME_USED)} from cinc group by 1, 2),
bw as (select company, period, {', '.join(item_sql(i) for i in co._BALANCE_USED)} from cbal group by 1, 2),
wd as (select *, case when revenue <> 0 then revenue else total_revenue end as r, short_term_debt + long_term_debt as debt from iw join bw using (company, period)),
ratios as ({' union all '.join(f"select company, period, '{s}' as section, '{n}' as ratio, {e} as value from wd" for (s, n), e in RATIO_SQL.items())})"""


@query("financial_ratios", f"with {RATIOS} select company, period, section, ratio, round(value, 6) as value from ratios where value is not null")
def financial_ratios(spark, d):
    out = co.financial_ratios(co.clean_income_statement(a.income_raw(spark, d)), co.clean_balance_sheet(a.balance_raw(spark, d)))
    return out.withColumn("value", F.round("value", 6))


@query("normalize_ratios", f"with {a.INCOME_RAW}, t as (select company, 'Margins' as section, item as ratio, period, value, count(value) over (partition by company, item) as known from inc) "
       "select company, section, ratio, period, value from t where known > 0")
def normalize_ratios(spark, d):
    doc = a.income_raw(spark, d).select("company", F.lit("Margins").alias("section"), F.col("item").alias("ratio"), "period", "text")
    return co.normalize_ratios(doc)
