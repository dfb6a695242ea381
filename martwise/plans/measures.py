"""Documented dashboard measures M1-M16, each one Spark query.

Global totals sum on decimal(38,0): a VND total over a large fact table
passes the bigint range.  Measures that mix two facts aggregate one union
in a single pass instead of joining one-row results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwise.functions.columns import count_if
from martwise.plans.dimensions import dim_date_spanning

FUNNEL_STEPS = ["page_view", "view_item", "add_to_cart", "begin_checkout", "purchase"]


def _dec(c: str):
    return F.col(c).cast("decimal(38,0)")


def sales(fact_orders: DataFrame, approx_customers: bool = False, rsd: float = 0.01) -> DataFrame:
    """M1-M5: revenue, orders, customers, average order value, completed.
    ``approx_customers`` counts distinct customers with a HyperLogLog++
    sketch (M3 at scale: fixed memory, no shuffle of distinct ids)."""
    customers = (F.approx_count_distinct("customer_id", rsd) if approx_customers
                 else F.count_distinct("customer_id"))
    out = fact_orders.agg(
        F.sum(_dec("total_vnd")).alias("total_revenue_vnd"),
        F.count_distinct("order_id").alias("total_orders"),
        customers.alias("distinct_customers"),
        F.count_distinct(F.when(F.col("status") == "completed", F.col("order_id"))).alias("completed_orders"))
    return out.select(
        F.coalesce("total_revenue_vnd", F.lit(0).cast("decimal(38,0)")).alias("total_revenue_vnd"),
        "total_orders", "distinct_customers",
        F.coalesce(F.try_divide(F.col("total_revenue_vnd").cast("double"), F.col("total_orders")),
                   F.lit(0.0)).alias("avg_order_value_vnd"),
        "completed_orders")


def items_revenue(fact_order_items: DataFrame) -> DataFrame:
    """M1, the notes' alternative: revenue as price x quantity over items,
    next to the stated line totals."""
    return fact_order_items.agg(
        F.coalesce(F.sum(_dec("unit_price_vnd") * _dec("quantity")), F.lit(0).cast("decimal(38,0)"))
         .cast("decimal(38,0)").alias("items_revenue_vnd"),
        F.coalesce(F.sum(_dec("line_total_vnd")), F.lit(0).cast("decimal(38,0)"))
         .cast("decimal(38,0)").alias("line_total_revenue_vnd"),
        F.count(F.lit(1)).alias("item_count"))


def payments(fact_payments: DataFrame) -> DataFrame:
    """M6-M9: amount, successes, success rate, refunds."""
    ok = F.col("payment_status") == "success"
    out = fact_payments.agg(
        F.sum(_dec("amount_vnd")).alias("total_payment_vnd"),
        count_if(ok).alias("successful_transactions"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum(F.when(F.col("payment_status") == "refunded", _dec("amount_vnd"))).alias("refund_vnd"))
    z = F.lit(0).cast("decimal(38,0)")
    return out.select(
        F.coalesce("total_payment_vnd", z).alias("total_payment_vnd"), "successful_transactions",
        "transaction_count",
        F.coalesce(F.try_divide(F.col("successful_transactions"), F.col("transaction_count")),
                   F.lit(0.0)).alias("payment_success_rate"),
        F.coalesce("refund_vnd", z).alias("refund_vnd"))


def journey(fact_cart_events: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Views, add-to-cart, and abandonment = 1 - orders / adds.
    Events and orders are aggregated as one union, in one pass."""
    u = fact_cart_events.select(F.col("event_type"), F.lit(None).cast("string").alias("order_id")) \
        .unionByName(fact_orders.select(F.lit(None).cast("string").alias("event_type"), "order_id"))
    out = u.agg(count_if(F.col("event_type") == "view_item").alias("total_views"),
                count_if(F.col("event_type") == "add_to_cart").alias("total_add_to_cart"),
                F.count_distinct("order_id").alias("total_orders"))
    conv = F.coalesce(F.try_divide(F.col("total_orders"), F.col("total_add_to_cart")), F.lit(0.0))
    return out.select("total_views", "total_add_to_cart", "total_orders",
                      (F.lit(1.0) - conv).alias("cart_abandonment_rate"))


def _daily_revenue(fact_orders: DataFrame) -> DataFrame:
    return (fact_orders.groupBy(F.to_date("order_date").alias("full_date"))
            .agg(F.sum("total_vnd").cast("bigint").alias("revenue_vnd")))


def revenue_ytd(fact_orders: DataFrame) -> DataFrame:
    """Year-to-date revenue on every day of the orders' calendar.
    The running sum is a window per year over the calendar (at most 366
    rows per partition), after the daily partial aggregate."""
    cal = dim_date_spanning(fact_orders, "order_date").select("full_date", "year")
    daily = cal.join(_daily_revenue(fact_orders), "full_date", "left") \
               .withColumn("revenue_vnd", F.coalesce("revenue_vnd", F.lit(0).cast("bigint")))
    w = Window.partitionBy("year").orderBy("full_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("full_date", "year", "revenue_vnd",
                        F.sum("revenue_vnd").over(w).cast("bigint").alias("revenue_ytd_vnd"))


def revenue_mom(fact_orders: DataFrame) -> DataFrame:
    """M14 + M15: monthly revenue, the previous month's, and growth (0 when
    there is no previous month or it is 0).  The lag runs over a gap-free
    month calendar: one row per month, so its single ordered window is
    bounded by the date span, not by the data."""
    cal = dim_date_spanning(fact_orders, "order_date")
    months = cal.select(F.trunc("full_date", "month").alias("month_start")).distinct()
    monthly = (fact_orders.groupBy(F.trunc(F.to_date("order_date"), "month").alias("month_start"))
               .agg(F.sum("total_vnd").cast("bigint").alias("revenue_vnd")))
    m = months.join(monthly, "month_start", "left") \
              .withColumn("revenue_vnd", F.coalesce("revenue_vnd", F.lit(0).cast("bigint")))
    prev = F.lag("revenue_vnd").over(Window.orderBy("month_start"))
    m = m.withColumn("revenue_prev_month_vnd", prev)
    growth = F.when(F.col("revenue_prev_month_vnd").isNull() | (F.col("revenue_prev_month_vnd") == 0), F.lit(0.0)) \
              .otherwise(F.try_divide(F.col("revenue_vnd") - F.col("revenue_prev_month_vnd"),
                                      F.col("revenue_prev_month_vnd")))
    return m.select("month_start", "revenue_vnd", "revenue_prev_month_vnd", growth.alias("mom_growth"))


def event_funnel(fact_cart_events: DataFrame) -> DataFrame:
    """Distinct sessions reaching each funnel step."""
    step_order = None
    for i, s in enumerate(FUNNEL_STEPS, start=1):
        cond = F.col("event_type") == s
        step_order = F.when(cond, F.lit(i)) if step_order is None else step_order.when(cond, F.lit(i))
    return (fact_cart_events.filter(F.col("event_type").isin(*FUNNEL_STEPS))
            .groupBy(step_order.alias("step_order"), F.col("event_type").alias("step"))
            .agg(F.count_distinct("session_id").alias("sessions"))
            .orderBy("step_order"))
