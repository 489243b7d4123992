"""Fixed schemas: input files, landed payloads and the star schema."""

from __future__ import annotations

STOCK_BARS = "date date, open double, high double, low double, close double, volume double, adjusted_close double"
INTRADAY_BARS = "datetime timestamp, open double, high double, low double, close double, volume double"
COIN_SERIES = "date date, timestamp bigint, price double, market_cap double, volume double"

#: Landed payloads, as DDL for from_json / read.json.
BAR_PAYLOAD = "map<string,map<string,string>>"
REPORT = "map<string,string>"
REPORTS_PAYLOAD = f"struct<annualReports:array<{REPORT}>,quarterlyReports:array<{REPORT}>>"
CHART_PAYLOAD = "struct<prices:array<array<double>>,market_caps:array<array<double>>,total_volumes:array<array<double>>>"
FALLBACK_PAYLOAD = (
    "struct<Data:struct<Data:array<struct<time:bigint,open:double,high:double,low:double,close:double,"
    "volumefrom:double,volumeto:double>>>>"
)
COIN_PAYLOAD = (
    "struct<id:string,symbol:string,name:string,categories:array<string>,description:map<string,string>,"
    "market_cap_rank:bigint,hashing_algorithm:string,genesis_date:string,market_data:struct<"
    "current_price:map<string,double>,market_cap:map<string,double>,total_volume:map<string,double>,"
    "circulating_supply:double,total_supply:double,max_supply:double,price_change_percentage_24h:double,"
    "price_change_percentage_7d:double,price_change_percentage_30d:double>>"
)
BLOCK_PAYLOAD = (
    "struct<active_addresses:double,transaction_count:double,average_transaction_value:double,"
    "block_height:double,hashrate:double,difficulty:double>"
)
GLOBAL_PAYLOAD = "struct<date:array<string>,total_market_cap:map<string,array<double>>>"
RATIO_PAYLOAD = "map<string,map<string,map<string,string>>>"
MATRIX = "map<string,map<string,double>>"

#: Star schema: columns, natural key, and the time column whose month partitions the table.
STAR = {
    "asset": ("asset_id bigint, symbol string, name string, asset_type string, exchange string, sector string, industry string, "
              "created_at timestamp, updated_at timestamp", ("symbol",), None),
    "stock_price": ("asset_id bigint, trade_date date, open_price double, high_price double, low_price double, close_price double, "
                    "adjusted_close double, volume double", ("asset_id", "trade_date"), "trade_date"),
    "technical_indicator": ("asset_id bigint, calc_date date, indicator_type string, value double, parameter1 double, parameter2 double",
                            ("asset_id", "calc_date", "indicator_type"), "calc_date"),
    "financial_ratio": ("asset_id bigint, report_date date, ratio_type string, period string, value double",
                        ("asset_id", "report_date", "ratio_type"), "report_date"),
    "income_statement": ("asset_id bigint, report_date date, period string, revenue double, cost_of_revenue double, gross_profit double, "
                         "operating_expense double, operating_income double, net_income double, eps double",
                         ("asset_id", "report_date", "period"), "report_date"),
    "balance_sheet": ("asset_id bigint, report_date date, period string, total_assets double, current_assets double, cash_equivalents double, "
                      "total_liabilities double, current_liabilities double, total_debt double, total_equity double",
                      ("asset_id", "report_date", "period"), "report_date"),
    "cash_flow": ("asset_id bigint, report_date date, period string, operating_cash_flow double, capital_expenditure double, free_cash_flow double, "
                  "dividend_paid double, net_borrowings double", ("asset_id", "report_date", "period"), "report_date"),
    "crypto_market_data": ("asset_id bigint, trade_date date, price_usd double, market_cap double, volume_24h double, circulating_supply double, "
                           "total_supply double, price_change_24h double", ("asset_id", "trade_date"), "trade_date"),
    "crypto_network_data": ("asset_id bigint, trade_date date, hashrate double, active_addresses double, avg_transaction_fee double, "
                            "avg_transaction_value double, transaction_count double", ("asset_id", "trade_date"), "trade_date"),
    "correlation_data": ("asset_id_1 bigint, asset_id_2 bigint, calc_date date, time_window string, correlation_value double",
                         ("asset_id_1", "asset_id_2", "calc_date", "time_window"), "calc_date"),
    "etl_log": ("log_id string, process_name string, execution_time timestamp, status string, error_message string, records_processed bigint, "
                "execution_duration double", ("log_id",), None),
}
