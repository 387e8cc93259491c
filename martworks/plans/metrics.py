"""Currency-normalised daily transaction metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from martworks.functions.money import safe_ratio, to_base_currency
from martworks.operators.filters import on_day

BASE_CURRENCY = 420
# Transaction types that count as turnover.
COUNTED_TYPES = [
    "c2a_incoming", "c2b_partner_incoming", "sbp_incoming", "sbp_outgoing", "transfer_incoming", "transfer_outgoing",
]


def global_metrics(transactions: DataFrame, currencies: DataFrame, run_date: str | None = None) -> DataFrame:
    """Turnover per day, currency and country, dated one day after the data.

    With `run_date` only the day before it is read; else every day of the input.
    """
    if run_date:
        day = (dt.date.fromisoformat(run_date) - dt.timedelta(days=1)).isoformat()
        transactions = on_day(transactions, "transaction_dt", day)
        currencies = on_day(currencies, "date_update", day)
    counted = transactions.where(
        (F.col("status") == "done") & (F.col("account_number_from") > 0) & (F.col("account_number_to") > 0)
        & F.col("transaction_type").isin(COUNTED_TYPES))
    rates = currencies.where(F.col("currency_code_with") == BASE_CURRENCY).select(
        F.to_date("date_update").alias("day"), "currency_code", "currency_with_div")
    rows = counted.withColumn("day", F.to_date("transaction_dt")).join(rates, ["day", "currency_code"])
    usd = to_base_currency(F.col("amount"), F.col("currency_with_div"))
    accounts = F.countDistinct("account_number_from")
    return rows.groupBy("day", "currency_code", "country").agg(
        F.sum(usd).cast("decimal(15,2)").alias("amount_total"),
        F.count("operation_id").alias("cnt_transactions"),
        safe_ratio(F.count("operation_id"), accounts, "decimal(18,0)").cast("decimal(15,2)").alias("avg_transactions_per_account"),
        accounts.alias("cnt_accounts_make_transactions"),
    ).select(
        F.date_add("day", 1).cast("timestamp_ntz").alias("date_update"), F.col("currency_code").alias("currency_from"),
        "country", "amount_total", "cnt_transactions", "avg_transactions_per_account", "cnt_accounts_make_transactions")
