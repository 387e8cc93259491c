"""A wide shipping log normalised to five tables, and the mart over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.money import flag
from martworks.functions.text import AGREEMENT_SEPARATOR, split_part
from martworks.functions.time import calendar_age
from martworks.operators.dims import assign_ids
from martworks.operators.joins import join_on_expr

BOOKED = "booked"
RECEIVED = "recieved"  # fixed value, spelled so in the source data
FINISHED = "finished"


def shipping_country_rates(log: DataFrame) -> DataFrame:
    pairs = log.select("shipping_country", "shipping_country_base_rate").distinct()
    return assign_ids(pairs, ["shipping_country", "shipping_country_base_rate"])


def shipping_agreement(log: DataFrame) -> DataFrame:
    text = F.col("vendor_agreement_description")
    return log.select("vendor_agreement_description").distinct().select(
        split_part(text, AGREEMENT_SEPARATOR, 1, "bigint").alias("agreement_id"),
        split_part(text, AGREEMENT_SEPARATOR, 2).alias("agreement_number"),
        split_part(text, AGREEMENT_SEPARATOR, 3, "decimal(14,2)").alias("agreement_rate"),
        split_part(text, AGREEMENT_SEPARATOR, 4, "decimal(14,2)").alias("agreement_commission"))


def shipping_transfer(log: DataFrame) -> DataFrame:
    text = F.col("shipping_transfer_description")
    kinds = log.select("shipping_transfer_description", "shipping_transfer_rate").distinct().select(
        split_part(text, AGREEMENT_SEPARATOR, 1).alias("transfer_type"),
        split_part(text, AGREEMENT_SEPARATOR, 2).alias("transfer_model"),
        "shipping_transfer_rate")
    return assign_ids(kinds, ["transfer_type", "transfer_model", "shipping_transfer_rate"])


def shipping_info(log: DataFrame, rates: DataFrame, transfers: DataFrame, agreements: DataFrame) -> DataFrame:
    """One row per shipping with the ids of its rate, agreement and transfer.

    The short tables come first, so their texts are not moved. Rows are dealt by agreement, which
    serves the unique rows as well as the join: the log is shuffled once.
    """
    named = transfers.select(
        F.col("id").alias("shipping_transfer_id"), "shipping_transfer_rate",
        F.concat_ws(":", "transfer_type", "transfer_model").alias("transfer_text"))
    with_transfer = join_on_expr(log, named, {
        "transfer_text": F.regexp_replace("shipping_transfer_description", AGREEMENT_SEPARATOR, ":"),
        "shipping_transfer_rate": F.col("shipping_transfer_rate")})
    # the base rate is part of the key: a country with two rates must not double rows
    with_rate = with_transfer.join(
        rates.withColumnRenamed("id", "shipping_country_rate_id"), ["shipping_country", "shipping_country_base_rate"])
    text = F.col("vendor_agreement_description")
    base = with_rate.select(
        "shipping_id", "shipping_plan_datetime", "payment", "vendor_id", "shipping_transfer_id", "shipping_country_rate_id",
        split_part(text, AGREEMENT_SEPARATOR, 1, "bigint").alias("agreement_id"), text,
    ).repartition("agreement_id").distinct()
    return base.join(agreements.select("agreement_id"), "agreement_id").select(
        "shipping_id", "shipping_plan_datetime", F.col("payment").alias("payment_amount"), "vendor_id",
        "shipping_transfer_id", F.col("agreement_id").alias("shipping_agreement_id"), "shipping_country_rate_id")


def shipping_status(log: DataFrame) -> DataFrame:
    """Last status and state, first booking and last receipt per shipping.

    One aggregate instead of self-joins; shippings not yet received are left out.
    """
    at = F.col("state_datetime")
    last = F.max(F.struct("state_datetime", "state", "status")).alias("last")
    return (
        log.groupBy("shipping_id").agg(
            last,
            F.min(F.when(F.col("state") == BOOKED, at)).alias("shipping_start_fact_datetime"),
            F.max(F.when(F.col("state") == RECEIVED, at)).alias("shipping_end_fact_datetime"))
        .where("shipping_start_fact_datetime is not null and shipping_end_fact_datetime is not null")
        .select("shipping_id", "last.status", "last.state", "shipping_start_fact_datetime", "shipping_end_fact_datetime")
    )


def _measures(rows: DataFrame) -> DataFrame:
    """Duration, delay, tax and profit of rows that carry times, amount and rates."""
    start, end, plan = (F.col(c) for c in (
        "shipping_start_fact_datetime", "shipping_end_fact_datetime", "shipping_plan_datetime"))
    late = end > plan
    took, delay = calendar_age(end, start), calendar_age(end, plan)
    amount = F.col("payment_amount")
    return rows.select(
        "shipping_id", "vendor_id", "transfer_type",
        took["months"].alias("shipping_months"), took["days"].alias("shipping_days"),
        F.datediff(end, start).alias("full_day_at_shipping"),
        flag(late).alias("is_delay"),
        flag(F.col("status") == FINISHED).alias("is_shipping_finish"),
        "shipping_end_fact_datetime", "shipping_plan_datetime",
        F.when(late, delay["days"]).otherwise(0).alias("delay_day_at_shipping"),
        F.when(late, F.datediff(end, plan)).otherwise(0).alias("delay_total_days"),
        "payment_amount",
        (amount * (F.col("shipping_country_base_rate") + F.col("agreement_rate") + F.col("shipping_transfer_rate"))).alias("vat"),
        (amount * F.col("agreement_commission")).alias("profit"))


def shipping_datamart(info: DataFrame, status: DataFrame, transfers: DataFrame, agreements: DataFrame,
                      rates: DataFrame) -> DataFrame:
    """The mart from the five normalised tables."""
    return _measures(
        info.join(status, "shipping_id")
        .join(transfers.withColumnRenamed("id", "shipping_transfer_id"), "shipping_transfer_id")
        .join(agreements.withColumnRenamed("agreement_id", "shipping_agreement_id"), "shipping_agreement_id")
        .join(rates.withColumnRenamed("id", "shipping_country_rate_id"), "shipping_country_rate_id"))


def shipping_datamart_of_log(log: DataFrame) -> DataFrame:
    """The mart straight from the log: one aggregate per shipping, no join and no surrogate ids.

    Attributes of a shipping are those of its last log row, whose agreement and
    transfer texts are taken apart in place. Shippings not yet received are left out.
    """
    at, text = F.col("state_datetime"), F.col("vendor_agreement_description")
    carried = ["shipping_plan_datetime", "payment", "vendor_id", "vendor_agreement_description",
               "shipping_transfer_description", "shipping_transfer_rate", "shipping_country_base_rate"]
    one = log.groupBy("shipping_id").agg(
        F.max(F.struct("state_datetime", "state", "status", *carried)).alias("last"),
        F.min(F.when(F.col("state") == BOOKED, at)).alias("shipping_start_fact_datetime"),
        F.max(F.when(F.col("state") == RECEIVED, at)).alias("shipping_end_fact_datetime"))
    rows = one.where("shipping_start_fact_datetime is not null and shipping_end_fact_datetime is not null").select(
        "shipping_id", "shipping_start_fact_datetime", "shipping_end_fact_datetime", "last.*")
    return _measures(rows.withColumnRenamed("payment", "payment_amount").withColumns({
        "transfer_type": split_part(F.col("shipping_transfer_description"), AGREEMENT_SEPARATOR, 1),
        "agreement_rate": split_part(text, AGREEMENT_SEPARATOR, 3, "decimal(14,2)"),
        "agreement_commission": split_part(text, AGREEMENT_SEPARATOR, 4, "decimal(14,2)")}))
