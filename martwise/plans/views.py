"""The three serving views V1-V3 as DataFrame functions (K6 registers them)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwise.functions.columns import (
    OVERDUE_AFTER_DAYS, as_of_literal, blank_to_null, count_if, usd_to_vnd_rounded, whole_days,
    whole_hours,
)
from martwise.operators.ranking import exact_rank

MINUTE_MICROS = 60_000_000
# Salt range for rows whose join key is null: they cannot match, so they
# are spread over this many hash buckets instead of all hashing to one.
NULL_KEY_SPREAD = 4096


def left_join_spread_nulls(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left equi-join on ``key`` where left rows with a null key (which
    never match) are spread over many tasks: the join runs on (key, salt);
    the salt is 0 for real keys and on the right, and a hash of the row
    for null keys."""
    salt = "_null_salt"
    lrow = F.xxhash64(*[F.col(c) for c in left.columns])
    l2 = left.withColumn(salt, F.when(F.col(key).isNull(), F.pmod(lrow, F.lit(NULL_KEY_SPREAD)))
                               .otherwise(F.lit(0).cast("bigint")))
    r2 = right.withColumn(salt, F.lit(0).cast("bigint"))
    return l2.join(r2, [key, salt], "left").drop(salt)


def journey_events(fact_cart_events: DataFrame) -> DataFrame:
    """V1: the events of known customers."""
    return fact_cart_events.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "session_id", "event_type", "event_timestamp", "product_id",
        F.col("source").alias("traffic_source"), "device", "utm_source", "utm_campaign", "event_key")


def journey_purchases(fact_orders: DataFrame) -> DataFrame:
    """A2: purchase totals of a customer."""
    return (fact_orders.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.min("order_date").alias("first_purchase_date"),
                 F.count(F.lit(1)).alias("total_purchases"),
                 F.sum("total_vnd").cast("bigint").alias("total_revenue_vnd")))


def customer_journey(fact_cart_events: DataFrame, dim_customers: DataFrame,
                     fact_orders: DataFrame) -> DataFrame:
    """V1: every event of a known customer with its touchpoint number (W1),
    the customer's first event (W2), and purchase totals (A2).

    W1 is ``row_number() over (partition by customer order by time)``;
    ``exact_rank`` computes it from per-(customer, minute) counts, so one
    very active customer is numbered by many tasks, not one.  Ties in time
    are broken by event_key.  W2 is a per-customer min (a partial
    aggregate).  Customer, purchases and first event are brought into one
    row per customer first, so the events meet one join only, whose skewed
    customers AQE can split.
    """
    ev = journey_events(fact_cart_events)
    micros = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    ranked = exact_rank(ev, micros, F.col("event_key"), partition_by=["customer_id"],
                        rank_col="touchpoint_sequence", coarse=F.floor(micros / MINUTE_MICROS))
    first_event = ev.groupBy("customer_id").agg(F.min("event_timestamp").alias("_first_event"))
    purchases = journey_purchases(fact_orders)
    cust = dim_customers.select("customer_id", "full_name", "customer_segment")
    known = first_event.join(cust, "customer_id", "left").join(purchases, "customer_id", "left")
    j = ranked.join(known, "customer_id", "left")
    return j.select(
        "customer_id", "full_name", "customer_segment", "session_id", "event_type", "event_timestamp",
        "touchpoint_sequence", "product_id", "traffic_source", "device", "utm_source", "utm_campaign",
        "first_purchase_date", "total_purchases", "total_revenue_vnd",
        whole_days("_first_event", "first_purchase_date").alias("days_to_first_purchase"))


def _bank_amount():
    """VND of a bank row, or the rounded USD fallback when VND is 0 (Q8)."""
    return F.coalesce(F.nullif(F.col("amount_vnd"), F.lit(0).cast("bigint")),
                      usd_to_vnd_rounded(F.col("amount_usd")))


def cashflow_daily(fact_orders: DataFrame, fact_payments: DataFrame,
                   fact_bank_transactions: DataFrame) -> DataFrame:
    """V2: daily sales, gateway receipts and bank flows.

    Each side is a daily partial aggregate (A3-A5), so only a few rows per
    day reach the two full outer joins (J4, J5); null dates stay separate
    rows.  Net cash flow is sales minus bank outflow (Q16)."""
    rev = (fact_orders.filter(~F.col("status").isin("cancelled", "refunded"))  # null status drops (Q7)
           .groupBy(F.to_date("order_date").alias("report_date"))
           .agg(F.sum("total_vnd").cast("bigint").alias("sales_revenue_vnd"),
                F.count(F.lit(1)).alias("order_count")))
    ok = F.col("payment_status") == "success"
    pay = (fact_payments.groupBy(F.to_date("payment_date").alias("report_date"))
           .agg(F.sum(F.when(ok, F.col("amount_vnd")).otherwise(F.lit(0).cast("bigint")))
                 .cast("bigint").alias("payments_received_vnd"),
                count_if(ok).alias("successful_payments"),
                count_if(F.col("payment_status") != "success").alias("failed_payments")))
    amt = _bank_amount()
    bank = (fact_bank_transactions.filter(F.col("status").isin("posted", "pending"))
            .groupBy(F.to_date("transaction_date").alias("report_date"))
            .agg(F.sum(F.when(amt > 0, amt).otherwise(F.lit(0).cast("bigint"))).cast("bigint")
                  .alias("bank_inflow_vnd"),
                 F.sum(F.when(amt < 0, F.abs(amt)).otherwise(F.lit(0).cast("bigint"))).cast("bigint")
                  .alias("bank_outflow_vnd")))
    r, p, b = rev.alias("r"), pay.alias("p"), bank.alias("b")
    rp = r.join(p, F.col("r.report_date") == F.col("p.report_date"), "full_outer").select(
        F.coalesce(F.col("r.report_date"), F.col("p.report_date")).alias("_rp_date"),
        F.col("r.report_date").alias("_r_date"), F.col("p.report_date").alias("_p_date"),
        "sales_revenue_vnd", "order_count", "payments_received_vnd", "successful_payments",
        "failed_payments")
    rpb = rp.join(b, rp["_rp_date"] == F.col("b.report_date"), "full_outer")
    z = F.lit(0).cast("bigint")
    return rpb.select(
        F.coalesce(F.col("_r_date"), F.col("_p_date"), F.col("b.report_date")).alias("report_date"),
        F.coalesce("sales_revenue_vnd", z).alias("sales_revenue_vnd"),
        F.coalesce("order_count", z).alias("order_count"),
        F.coalesce("payments_received_vnd", z).alias("payments_received_vnd"),
        F.coalesce("successful_payments", z).alias("successful_payments"),
        F.coalesce("failed_payments", z).alias("failed_payments"),
        F.coalesce("bank_inflow_vnd", z).alias("bank_inflow_vnd"),
        F.coalesce("bank_outflow_vnd", z).alias("bank_outflow_vnd"),
        (F.coalesce("sales_revenue_vnd", z) - F.coalesce("bank_outflow_vnd", z)).alias("net_cashflow_vnd"),
    ).orderBy("report_date")


def payment_status(fact_orders: DataFrame, dim_customers: DataFrame, fact_payments: DataFrame,
                   as_of=None) -> DataFrame:
    """V3: each order with its customer and gateway payments.

    The payment join is many-to-many on transaction_id (kept, Q12), but a
    blank id is no id: such orders get a unique never-matching key, so they
    spread over all tasks instead of piling on one, and blank payment ids
    never fan out.  Orders without a customer are spread the same way."""
    now = as_of_literal(as_of)
    o = fact_orders.withColumn(
        "_tid", F.coalesce(blank_to_null(F.col("transaction_id")),
                           F.concat(F.lit("\u0000"), F.col("order_key"))))
    p = fact_payments.filter(blank_to_null(F.col("transaction_id")).isNotNull()).select(
        F.col("transaction_id").alias("_tid"), "payment_key", "payment_date",
        F.col("payment_status").alias("gateway_payment_status"), F.col("amount_vnd").alias("paid_amount_vnd"))
    c = dim_customers.select("customer_id", F.col("full_name").alias("customer_name"),
                             F.col("email").alias("customer_email"))
    j = left_join_spread_nulls(o, c, "customer_id").join(p, "_tid", "left")
    age = whole_days(F.col("order_date"), now)
    unpaid = F.col("payment_date").isNull()
    st = F.col("gateway_payment_status")
    return j.select(
        "order_key", "order_id", "order_number", "customer_id", "customer_name", "customer_email",
        "order_date", "channel", "total_vnd", F.col("payment_status").alias("order_payment_status"),
        "payment_gateway", "payment_key", "payment_date", "gateway_payment_status", "paid_amount_vnd",
        F.when(st == "success", "Paid").when(st == "failed", "Failed")
         .when(unpaid & (age > OVERDUE_AFTER_DAYS), "Overdue").when(unpaid, "Pending")
         .otherwise("Unknown").alias("payment_status_category"),
        F.when(~unpaid, whole_hours(F.col("order_date"), F.col("payment_date"))).alias("payment_delay_hours"),
        F.when((st != "success") | st.isNull(),
               F.col("total_vnd") - F.coalesce(F.col("paid_amount_vnd"), F.lit(0).cast("bigint")))
         .otherwise(F.lit(0).cast("bigint")).alias("outstanding_amount_vnd"),
        F.when(unpaid & (age > OVERDUE_AFTER_DAYS), age).otherwise(F.lit(0).cast("bigint"))
         .alias("days_overdue"))
