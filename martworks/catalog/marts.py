"""Sales-like marts over customers, orders, line items and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.catalog.registry import Tables, money, query, ts_sql
from martworks.functions.time import calendar_age
from martworks.operators.filters import on_day
from martworks.operators.grouping import count_by, latest_per_key
from martworks.operators.ranking import quintile
from martworks.plans import metrics, rfm, sales, settlement, shipping
from martworks.session import reliable

# ---- customer segments ---------------------------------------------------------------


def rfm_users(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"))


def rfm_closed(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_ts"), money("o_totalprice").alias("payment"))


_RFM = """with m as (
  select c_custkey as u, coalesce(max(o_orderdate), timestamp '1970-01-01') as r, count(o_orderkey) as f,
         coalesce(sum(o_totalprice::decimal(14,2)), 0) as v
  from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by c_custkey)
"""
_TILE = {n: f"(ntile(5) over (order by {c}, u))::bigint as {n}" for n, c in (
    ("recency", "r"), ("frequency", "f"), ("monetary_value", "v"))}


@query("rfm_segments", _RFM + f"select u as user_id, {_TILE['recency']}, {_TILE['frequency']}, {_TILE['monetary_value']} from m")
def _(t):
    return rfm.rfm_segments(rfm_users(t), rfm_closed(t))


@query("rfm_recency", _RFM + f"select u as user_id, {_TILE['recency']} from m")
def _(t):
    return rfm.rfm_recency(rfm_users(t), rfm_closed(t))


@query("rfm_frequency", _RFM + f"select u as user_id, {_TILE['frequency']} from m")
def _(t):
    return rfm.rfm_frequency(rfm_users(t), rfm_closed(t))


@query("rfm_monetary", _RFM + f"select u as user_id, {_TILE['monetary_value']} from m")
def _(t):
    return rfm.rfm_monetary(rfm_users(t), rfm_closed(t))


@query("ntile_distributed", """with m as (select o_custkey, count(*) as cnt from orders group by 1)
select o_custkey, cnt, (ntile(7) over (order by cnt, o_custkey))::bigint as tile from m""")
def _(t):
    return quintile(count_by(t.orders, "o_custkey"), "cnt", "o_custkey", 7)


@query("latest_status", """select o_custkey as order_id, status from (
  select o_custkey, o_orderstatus as status, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
  from orders) where rn = 1 and o_custkey in (select c_custkey from customer)""")
def _(t):
    log = t.orders.select(F.col("o_custkey").alias("order_id"), F.col("o_orderdate").alias("dttm"),
                          F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status_id"))
    return rfm.orders_with_latest_status(t.customer.select(F.col("c_custkey").alias("order_id")), log)


@query("latest_row_per_key", f"""select o_custkey, o_orderkey, o_orderstatus, o_totalprice, {ts_sql('o_orderdate')} as o_orderdate, o_orderpriority
from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""")
def _(t):
    return latest_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---- shipping ------------------------------------------------------------------------

def shipping_log(t: Tables) -> DataFrame:
    """Two log rows (booked, received) per line; the shipping id is a digest of the whole line."""
    line = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", money("l_extendedprice").alias("price"),
        money("l_tax").alias("tax"), money("l_discount").alias("discount"), "l_returnflag", "l_linestatus")
    nation = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "n_name", "n_nationkey")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate").join(nation, "o_custkey")
    # lines are moved once, and before they carry a digest, which does not compress
    rows = line.join(orders, "l_orderkey").withColumn("shipping_id", F.md5(F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd"),
        "price", "tax", "discount", "l_returnflag", "l_linestatus")))
    percent = lambda c: (F.col(c) * 100).cast("bigint")
    agreement = F.concat_ws(":", F.col("l_suppkey") * 10000 + percent("tax") * 100 + percent("discount"),
                            F.concat(F.lit("agreement-"), F.col("l_suppkey")), F.col("tax"), F.col("discount"))
    return rows.select(
        "shipping_id",
        F.col("price").alias("payment"), F.col("l_suppkey").alias("vendor_id"),
        (F.col("o_orderdate") + F.expr("interval 60 days")).alias("shipping_plan_datetime"),
        F.col("n_name").alias("shipping_country"),
        ((F.col("n_nationkey") % 10 + 1) / F.lit(100)).cast("decimal(14,3)").alias("shipping_country_base_rate"),
        agreement.alias("vendor_agreement_description"),
        F.concat_ws("::", "l_returnflag", "l_linestatus").alias("shipping_transfer_description"),
        (F.col("l_linenumber") / F.lit(1000)).cast("decimal(14,3)").alias("shipping_transfer_rate"),
        F.when(F.col("l_linestatus") == "F", "finished").otherwise("in_progress").alias("status"),
        F.inline(F.array(
            F.struct(F.lit("booked").alias("state"), F.col("o_orderdate").alias("state_datetime")),
            F.struct(F.lit("recieved").alias("state"), F.col("l_shipdate").alias("state_datetime")))))


def staged_log(t: Tables) -> DataFrame:
    """The log as a stored table, for marts that read it several times."""
    return reliable(shipping_log(t))


_SHIP = """with line as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice::decimal(14,2) as price,
         l_tax::decimal(14,2) as tax, l_discount::decimal(14,2) as discount, l_returnflag, l_linestatus from lineitem),
one as (select distinct md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'),
          price, tax, discount, l_returnflag, l_linestatus)) as shipping_id, * from line),
ship as (select shipping_id, price as payment, l_suppkey as vendor_id,
  o_orderdate + interval 60 day as plan, n_name as country, (n_nationkey % 10 + 1)::decimal(14,3) / 100 as country_rate0,
  n_nationkey % 10 + 1 as country_pct,
  l_suppkey * 10000 + (tax * 100)::bigint * 100 + (discount * 100)::bigint as agreement_id,
  'agreement-' || l_suppkey as agreement_number, tax, discount,
  l_returnflag as transfer_type, l_linestatus as transfer_model, l_linenumber as transfer_mil,
  case when l_linestatus = 'F' then 'finished' else 'in_progress' end as status,
  o_orderdate as booked, l_shipdate as received
  from one join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey),
rates as (select row_number() over (order by country, country_pct) as id, country, country_pct from (select distinct country, country_pct from ship)),
transfers as (select row_number() over (order by transfer_type, transfer_model, transfer_mil) as id, transfer_type, transfer_model, transfer_mil
  from (select distinct transfer_type, transfer_model, transfer_mil from ship))
"""


@query("shipping_country_rates", _SHIP + """select id, country as shipping_country, country_pct::double / 100 as shipping_country_base_rate from rates""")
def _(t):
    return shipping.shipping_country_rates(shipping_log(t))


@query("shipping_agreement", _SHIP + """select distinct agreement_id, agreement_number, tax::double as agreement_rate,
discount::double as agreement_commission from ship""")
def _(t):
    return shipping.shipping_agreement(shipping_log(t))


@query("shipping_transfer", _SHIP + """select id, transfer_type, transfer_model, transfer_mil::double / 1000 as shipping_transfer_rate from transfers""")
def _(t):
    return shipping.shipping_transfer(shipping_log(t))


@query("shipping_info", _SHIP + f"""select shipping_id, {ts_sql('plan')} as shipping_plan_datetime, payment::double as payment_amount, vendor_id,
transfers.id as shipping_transfer_id, agreement_id as shipping_agreement_id, rates.id as shipping_country_rate_id
from ship join transfers using (transfer_type, transfer_model, transfer_mil) join rates using (country, country_pct)""")
def _(t):
    log = staged_log(t)
    return shipping.shipping_info(
        log, shipping.shipping_country_rates(log), shipping.shipping_transfer(log), shipping.shipping_agreement(log))


@query("shipping_status", _SHIP + f"""select shipping_id, status, case when received >= booked then 'recieved' else 'booked' end as state,
{ts_sql('booked')} as shipping_start_fact_datetime, {ts_sql('received')} as shipping_end_fact_datetime from ship""")
def _(t):
    return shipping.shipping_status(shipping_log(t))


@query("shipping_datamart", _SHIP + f""", aged as (select *, age(received, booked) as took, age(received, plan) as delay from ship)
select shipping_id, vendor_id, transfer_type,
 (datepart('year', took) * 12 + datepart('month', took))::bigint as shipping_months, datepart('day', took)::bigint as shipping_days,
 date_diff('day', booked, received)::bigint as full_day_at_shipping,
 (received > plan)::bigint as is_delay, (status = 'finished')::bigint as is_shipping_finish,
 {ts_sql('received')} as shipping_end_fact_datetime, {ts_sql('plan')} as shipping_plan_datetime,
 (case when received > plan then datepart('day', delay) else 0 end)::bigint as delay_day_at_shipping,
 (case when received > plan then date_diff('day', plan, received) else 0 end)::bigint as delay_total_days,
 payment::double as payment_amount,
 ((payment * 100)::bigint * (country_pct * 10 + (tax * 1000)::bigint + transfer_mil))::double / 100000 as vat,
 (payment::decimal(16,2) * discount::decimal(10,2))::double as profit
from aged""")
def _(t):
    return shipping.shipping_datamart_of_log(shipping_log(t))


@query("calendar_age", """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
 (datepart('year', a) * 12 + datepart('month', a))::bigint as months, datepart('day', a)::bigint as days
from (select *, age(l_shipdate, o_orderdate) as a from lineitem join orders on o_orderkey = l_orderkey)""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    age = calendar_age(F.col("l_shipdate"), F.col("o_orderdate"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", age["months"].alias("months"), age["days"].alias("days"))


# ---- sales and retention -------------------------------------------------------------


def sales_increment(t: Tables) -> DataFrame:
    """One row per line item in the shape of an order increment."""
    buyer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_name", "c_mktsegment")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate").join(buyer, "o_custkey")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag").join(
        orders, "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("uniq_id"), F.col("o_orderdate").alias("date_time"),
            F.col("c_nationkey").alias("city_id"), F.concat(F.lit("CITY_"), "c_nationkey").alias("city_name"),
            F.col("o_custkey").alias("customer_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
            F.col("l_partkey").alias("item_id"), F.concat(F.lit("item "), "l_partkey").alias("item_name"),
            F.col("l_quantity").cast("int").alias("quantity"), money("l_extendedprice").alias("payment_amount"),
            F.when(F.col("l_returnflag") == "R", "refunded").otherwise("shipped").alias("status"))


_SALES = """with inc as (
  select o_orderdate as date_time, c_nationkey as city_id, 'CITY_' || c_nationkey as city_name, o_custkey as customer_id, c_name as first_name,
   c_mktsegment as last_name, l_partkey as item_id, l_quantity::int as quantity, l_extendedprice::decimal(14,2) as payment_amount,
   case when l_returnflag = 'R' then 'refunded' else 'shipped' end as status
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey),
fact as (select strftime(date_time, '%Y%m%d')::bigint as date_id, week(date_time) as week_of_year, item_id, customer_id, city_id, quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end as payment_amount, status from inc)
"""


@query("fact_sales", _SALES + """select date_id, item_id, customer_id, city_id, quantity::bigint as quantity,
payment_amount::double as payment_amount, status from fact""")
def _(t):
    return sales.fact_sales(sales_increment(t), sales.calendar(t.orders, "o_orderdate"))


@query("fact_sales_of_day", _SALES + """select date_id, item_id, customer_id, city_id, quantity::bigint as quantity,
payment_amount::double as payment_amount, status from fact where date_id = 19960315""")
def _(t):
    """The fact of one business date; the date reaches the scan of orders."""
    day = on_day(sales_increment(t), "date_time", "1996-03-15")
    return sales.fact_sales(day, sales.calendar(t.orders, "o_orderdate"))


@query("customer_retention", _SALES + """, agg as (
  select week_of_year, customer_id, item_id, count(*) as orders, count(*) filter (status = 'refunded') as refunds, sum(payment_amount) as revenue
  from fact group by all)
select count(*) filter (orders = 1) as new_customers_count, count(*) filter (orders > 1) as returning_customers_count,
 count(*) filter (refunds > 0) as refunded_customer_count, 'weekly' as period_name, week_of_year::bigint as period_id, item_id,
 coalesce(sum(revenue) filter (orders = 1), 0)::double as new_customers_revenue,
 coalesce(sum(revenue) filter (orders > 1), 0)::double as returning_customers_revenue,
 coalesce(sum(revenue) filter (refunds > 0), 0)::double as customers_refunded
from agg group by week_of_year, item_id""")
def _(t):
    cal = sales.calendar(t.orders, "o_orderdate")
    return sales.customer_retention(sales.fact_sales(sales_increment(t), cal), cal)


@query("dim_customers_new", """select o_custkey as customer_id, c_name as first_name, c_mktsegment as last_name, c_nationkey as city_id
from customer join (select distinct o_custkey from orders join lineitem on l_orderkey = o_orderkey) on o_custkey = c_custkey
where c_acctbal <= 5000""")
def _(t):
    existing = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("customer_id"))
    return sales.new_customers(sales_increment(t), existing)


@query("dim_items_new", """select distinct l_partkey as item_id, 'item ' || l_partkey as item_name
from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey where p_size <= 25""")
def _(t):
    existing = t.part.where("p_size > 25").select(F.col("p_partkey").alias("item_id"))
    return sales.new_items(sales_increment(t), existing)


@query("dim_cities_new", """select distinct c_nationkey::bigint as city_id, 'CITY_' || c_nationkey as city_name
from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
join nation on n_nationkey = c_nationkey where n_regionkey <> 0""")
def _(t):
    existing = t.nation.where("n_regionkey = 0").select(F.col("n_nationkey").alias("city_id"))
    return sales.new_cities(sales_increment(t), existing)


# ---- settlement and couriers ---------------------------------------------------------

_AS_OF = "2001-01-01 00:00:00"


def _validity(df: DataFrame, gone) -> DataFrame:
    return df.withColumn("active_to", F.when(gone, F.lit("2000-01-01 00:00:00")).otherwise(F.lit("2099-12-31 00:00:00")).cast("timestamp_ntz"))


def star_timestamps(t: Tables) -> DataFrame:
    days = t.orders.select(F.to_date("o_orderdate").alias("date")).distinct()
    return days.select(F.date_format("date", "yyyyMMdd").cast("int").alias("id"), "date",
                       F.year("date").alias("year"), F.month("date").alias("month"))


def star_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 10).alias("restaurant_id"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("timestamp_id"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("CANCELLED").alias("order_status"))


@query("settlement_report", """select s_suppkey as restaurant_id, s_name as restaurant_name, strftime(o_orderdate, '%Y-%m-%d') as settlement_date,
 count(distinct o_orderkey) as orders_count, sum(total)::double as orders_total_sum,
 sum(pay)::double as orders_bonus_payment_sum, sum(gain)::double as orders_bonus_granted_sum,
 (0.25 * sum(total)::decimal(20,2))::decimal(14,2)::double as order_processing_fee,
 (0.75 * sum(total)::decimal(20,2) - sum(pay)::decimal(20,2))::decimal(14,2)::double as restaurant_reward_sum
from (select l_orderkey, l_partkey, l_extendedprice::decimal(14,2) as total,
        (l_extendedprice::decimal(14,2) * l_discount::decimal(14,2))::decimal(14,2) as pay,
        (l_extendedprice::decimal(14,2) * l_tax::decimal(14,2))::decimal(14,2) as gain from lineitem)
join orders on o_orderkey = l_orderkey and o_orderstatus = 'F'
join part on p_partkey = l_partkey and p_size <= 40 and p_partkey % 10 = o_custkey % 10
join supplier on s_suppkey = o_custkey % 10 and s_acctbal > 0
group by s_suppkey, s_name, o_orderdate""")
def _(t):
    price = money("l_extendedprice")
    facts = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), price.alias("total_sum"),
        (price * money("l_discount")).cast("decimal(14,2)").alias("bonus_payment"),
        (price * money("l_tax")).cast("decimal(14,2)").alias("bonus_grant"))
    products = _validity(t.part.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 10).alias("restaurant_id"), "p_size"),
                         F.col("p_size") > 40)
    places = _validity(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("restaurant_name"), "s_acctbal"),
                       F.col("s_acctbal") <= 0)
    return settlement.settlement_report(
        facts, star_orders(t), star_timestamps(t), products, places, F.lit(_AS_OF).cast("timestamp_ntz"))


@query("courier_ledger", """with base as (
  select l_suppkey as courier_id, s_name as courier_name, year(o_orderdate) as y, month(o_orderdate) as m, count(*) as n,
   sum(l_extendedprice::decimal(14,2))::decimal(20,2) as total, sum(1 + l_linenumber % 5) as rates,
   sum((l_extendedprice::decimal(14,2) * l_tax::decimal(14,2))::decimal(14,2))::decimal(20,2) as tips
  from lineitem join orders on o_orderkey = l_orderkey join supplier on s_suppkey = l_suppkey group by all),
paid as (select *, (case when rates * 10 < 40 * n then greatest(0.05 * total, 100) when rates * 10 < 45 * n then greatest(0.07 * total, 150)
   when rates * 10 < 49 * n then greatest(0.08 * total, 175) else greatest(0.10 * total, 200) end)::decimal(14,2) as pay from base)
select courier_id, courier_name, y as settlement_year, m as settlement_month, n as orders_count, total::double as orders_total_sum,
 ((200 * rates + n) // (2 * n))::double / 100 as rate_avg, (total * 0.25)::decimal(14,2)::double as order_processing_fee,
 pay::double as courier_order_sum, tips::double as courier_tips_sum, (pay + tips * 0.95)::decimal(14,2)::double as courier_reward_sum
from paid""")
def _(t):
    price = money("l_extendedprice")
    deliveries = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("courier_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("delivery_id"), price.alias("sum"),
        (price * money("l_tax")).cast("decimal(14,2)").alias("tip_sum"), (1 + F.col("l_linenumber") % 5).cast("smallint").alias("rate"))
    couriers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("courier_name"))
    return settlement.courier_ledger(deliveries, couriers, star_orders(t), star_timestamps(t))


# ---- daily metrics -------------------------------------------------------------------

# Transaction type for each kind of event; the last one is not counted.
_TYPES = {"click": "sbp_incoming", "view": "transfer_incoming", "purchase": "c2a_incoming", "signup": "sbp_outgoing", "error": "authorisation"}


def bank_transactions(t: Tables) -> DataFrame:
    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in _TYPES.items()])
    return t.events.select(
        F.col("event_id").alias("operation_id"), (F.col("user_id") - 3).alias("account_number_from"),
        (F.get_json_object("props", "$.k").cast("int") - 1).alias("account_number_to"),
        (F.col("user_id") % 25).cast("int").alias("currency_code"), F.concat(F.lit("C"), F.col("user_id") % 7).alias("country"),
        F.when(F.col("value") < 1, "blocked").otherwise("done").alias("status"), kind.alias("transaction_type"),
        (F.col("value").cast("decimal(14,2)") * 100).cast("bigint").alias("amount"), F.col("ts").alias("transaction_dt"))


def bank_currencies(t: Tables) -> DataFrame:
    """A base rate and a decoy rate for each day and currency that occurs."""
    days = t.events.select(F.to_date("ts").alias("day"), (F.col("user_id") % 25).cast("int").alias("currency_code")).distinct()
    return days.select(
        F.col("day").cast("timestamp_ntz").alias("date_update"), "currency_code",
        F.explode(F.array(F.lit(420), F.lit(840))).alias("currency_code_with"),
        ((100 + F.col("currency_code") + F.dayofmonth("day")) / F.lit(100)).cast("decimal(5,2)").alias("currency_with_div"))


@query("global_metrics", f"""with tx as (select event_id, user_id - 3 as account, (user_id % 25)::int as code, 'C' || (user_id % 7) as country,
  ts::date as day, (value::decimal(14,2) * 100)::bigint as amount from events
  where value >= 1 and user_id - 3 > 0 and json_extract_string(props, '$.k')::int - 1 > 0 and event_type <> 'error')
select {ts_sql("(day + interval 1 day)::timestamp")} as date_update, code::bigint as currency_from, country,
 (sum((amount * (100 + code + day(day)) + 50) // 100)::decimal(20,0))::double / 100 as amount_total, count(*) as cnt_transactions,
 ((200 * count(*) + count(distinct account)) // (2 * count(distinct account)))::double / 100 as avg_transactions_per_account,
 count(distinct account) as cnt_accounts_make_transactions
from tx group by day, code, country""")
def _(t):
    return metrics.global_metrics(bank_transactions(t), bank_currencies(t))
