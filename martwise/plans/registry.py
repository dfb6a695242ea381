"""Registered queries: one per operator family of the survey, each a
function (spark, sf_dir) -> DataFrame over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise.operators import quality, rfm, sketches
from martwise.operators.dedup import keep_first
from martwise.plans import checks, colocated, measures, view_sql, views
from martwise.plans.gold import EVENTS_AS_OF, ORDERS_AS_OF, DriverGold
from martwise.session import shared_folder

LINEITEM_SEQ = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]


def _g(spark: SparkSession, sf_dir: str) -> DriverGold:
    return DriverGold(spark, sf_dir)


def cashflow_daily(spark, sf_dir):
    g = _g(spark, sf_dir)
    return views.cashflow_daily(g.fact_orders, g.fact_payments, g.fact_bank_transactions)


def payment_status(spark, sf_dir):
    g = _g(spark, sf_dir)
    return views.payment_status(g.fact_orders, g.dim_customers, g.fact_payments, as_of=ORDERS_AS_OF)


def customer_journey(spark, sf_dir):
    g = _g(spark, sf_dir)
    return views.customer_journey(g.fact_cart_events, g.dim_customers, g.fact_orders)


def _stored_view(name, as_of=None):
    """The view's SQL text, as the catalog stores it, over the gold tables it names."""
    def run(spark, sf_dir):
        g = _g(spark, sf_dir)
        return view_sql.run_view(spark, name, {t: getattr(g, t) for t in view_sql.TABLES}, as_of)
    return run


def customer_aggregates(spark, sf_dir):
    g = _g(spark, sf_dir)
    return rfm.update_customer_aggregates(g.dim_customers, g.rfm_orders, as_of=ORDERS_AS_OF)


def _by_customer(g: DriverGold, frames: dict[str, DataFrame]) -> dict[str, colocated.Colocated]:
    """Gold tables written and dealt out by customer, in as many buckets as the session has shuffle partitions."""
    return colocated.gold_by_customer(g, frames, shared_folder(g.spark), int(g.spark.conf.get("spark.sql.shuffle.partitions")))


def customer_journey_colocated(spark, sf_dir):
    """V1 bucket beside bucket."""
    g = _g(spark, sf_dir)
    t = _by_customer(g, {n: getattr(g, n) for n in colocated.SORTED})
    return colocated.customer_journey(t["fact_cart_events"], t["dim_customers"], t["fact_orders"])


def customer_aggregates_colocated(spark, sf_dir):
    """B12 bucket beside bucket."""
    g = _g(spark, sf_dir)
    t = _by_customer(g, {"dim_customers": g.dim_customers, "fact_orders": g.rfm_orders})
    return colocated.update_customer_aggregates(t["dim_customers"], t["fact_orders"], as_of=ORDERS_AS_OF)


def rfm_segments(spark, sf_dir):
    g = _g(spark, sf_dir)
    agg = rfm.order_aggregates(g.rfm_orders)
    customers = g.dim_customers.select("customer_id").join(agg, "customer_id", "left").fillna(
        0, subset=["lifetime_value_vnd", "total_orders"])
    scored = rfm.rfm_scores(customers, as_of=ORDERS_AS_OF)
    return scored.select("customer_id", "recency_days", "total_orders", "lifetime_value_vnd",
                         "r_score", "f_score", "m_score", "customer_segment")


def rfm_distribution(spark, sf_dir):
    return rfm.segment_distribution(customer_aggregates(spark, sf_dir))


def dim_date(spark, sf_dir):
    return _g(spark, sf_dir).dim_date


def dim_customers(spark, sf_dir):
    return _g(spark, sf_dir).dim_customers


def dim_products(spark, sf_dir):
    return _g(spark, sf_dir).dim_products


def dim_locations(spark, sf_dir):
    return _g(spark, sf_dir).dim_locations


def dim_staff(spark, sf_dir):
    return _g(spark, sf_dir).dim_staff


def fact_orders_union(spark, sf_dir):
    return _g(spark, sf_dir).fact_orders


def order_items_explode(spark, sf_dir):
    return _g(spark, sf_dir).fact_order_items


def fact_payments(spark, sf_dir):
    return _g(spark, sf_dir).fact_payments


def fact_cart_events(spark, sf_dir):
    return _g(spark, sf_dir).fact_cart_events


def fact_bank_transactions(spark, sf_dir):
    return _g(spark, sf_dir).fact_bank_transactions


# -- quality -----------------------------------------------------------------

def _null_checks(g: DriverGold) -> list[DataFrame]:
    return [quality.null_counts(getattr(g, name), cols, name) for name, cols in checks.NULL_COLUMNS.items()]


def _dup_checks(g: DriverGold) -> list[DataFrame]:
    return [
        quality.duplicate_counts(g.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
        quality.duplicate_counts(g.fact_order_items, ["order_item_key"], "fact_order_items"),
        quality.duplicate_counts(g.fact_payments, ["payment_key"], "fact_payments"),
        quality.duplicate_counts(g.fact_orders, ["order_key"], "fact_orders"),
    ]


def _range_checks(g: DriverGold) -> list[DataFrame]:
    return [quality.date_range(getattr(g, name), column, name, as_of=AS_OF.get(name, ORDERS_AS_OF))
            for name, column in checks.DATE_COLUMNS.items()]


def _amount_checks(g: DriverGold) -> list[DataFrame]:
    return [quality.amount_stats_many([
        (g.fact_orders, ["total_vnd", "total_usd"], "fact_orders", False),
        (g.fact_order_items, ["unit_price_vnd", "line_total_vnd"], "fact_order_items", False),
        (g.fact_payments, ["amount_vnd", "amount_usd"], "fact_payments", False),
        (g.fact_bank_transactions, ["amount_vnd", "amount_usd"], "fact_bank_transactions", True),
        (g.dim_products, ["price_vnd", "price_usd"], "dim_products", False),
    ])]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dq_nulls(spark, sf_dir):
    return _union(_null_checks(_g(spark, sf_dir)))


def dq_duplicates(spark, sf_dir):
    return _union(_dup_checks(_g(spark, sf_dir)))


def dedup_first(spark, sf_dir):
    li = _g(spark, sf_dir).table("lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"], LINEITEM_SEQ)


def dq_date_range(spark, sf_dir):
    return _union(_range_checks(_g(spark, sf_dir)))


def dq_amounts(spark, sf_dir):
    return _union(_amount_checks(_g(spark, sf_dir)))


# the run times that the date checks of the driver data hold against
AS_OF = {"fact_cart_events": EVENTS_AS_OF}


def quality_report(spark, sf_dir):
    """DQ5: null and date-range checks of a table in one profile pass each,
    plus the duplicate and amount checks."""
    g = _g(spark, sf_dir)
    profiles = []
    for name, cols in checks.NULL_COLUMNS.items():
        profiles.append(quality.table_profile(getattr(g, name), name, cols, checks.DATE_COLUMNS.get(name),
                                              AS_OF.get(name, ORDERS_AS_OF)))
    return quality.quality_report(dups=_dup_checks(g), amounts=_amount_checks(g), profiles=profiles)


def surrogate_keys(spark, sf_dir):
    return _g(spark, sf_dir).fact_orders.select("order_key", "order_id", "source", "channel")


def date_keys(spark, sf_dir):
    return _g(spark, sf_dir).fact_cart_events.select("event_id", "event_timestamp", "event_date_key")


def usd_to_vnd(spark, sf_dir):
    return _g(spark, sf_dir).fact_bank_transactions.select("transaction_id", "amount_usd", "amount_vnd")


def table_row_counts(spark, sf_dir):
    g = _g(spark, sf_dir)
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in g.all_tables().items()])


# -- measures ----------------------------------------------------------------

def measure_sales(spark, sf_dir):
    return measures.sales(_g(spark, sf_dir).fact_orders)


def measure_items_revenue(spark, sf_dir):
    return measures.items_revenue(_g(spark, sf_dir).fact_order_items)


def measure_payments(spark, sf_dir):
    return measures.payments(_g(spark, sf_dir).fact_payments)


def measure_journey(spark, sf_dir):
    g = _g(spark, sf_dir)
    return measures.journey(g.fact_cart_events, g.fact_orders)


def revenue_ytd(spark, sf_dir):
    return measures.revenue_ytd(_g(spark, sf_dir).fact_orders)


def revenue_mom(spark, sf_dir):
    return measures.revenue_mom(_g(spark, sf_dir).fact_orders)


def event_funnel(spark, sf_dir):
    return measures.event_funnel(_g(spark, sf_dir).fact_cart_events)


def distinct_customers_ytd(spark, sf_dir):
    """M3 per month and year to date, from one theta sketch a day."""
    return sketches.running_distinct(sketches.daily_distinct(_g(spark, sf_dir).fact_orders, "order_date", "customer_id"))


def event_funnel_passed(spark, sf_dir):
    """M16's steps and how many sessions went through all of them, by intersecting sketches."""
    daily = sketches.daily_distinct(_g(spark, sf_dir).fact_cart_events, "event_timestamp", "session_id", ["event_type"])
    return sketches.funnel(daily, measures.FUNNEL_STEPS)


def amount_quantiles(spark, sf_dir):
    """Quartiles of the order amounts of each year from daily KLL sketches, held against the orders: the share of
    orders below and up to each answer, and whether the rank asked for lies between them within the stated error."""
    orders = _g(spark, sf_dir).fact_orders
    daily = sketches.daily_quantiles(orders, "order_date", ["total_vnd"]).filter(F.col("day").isNotNull())
    ranks = (0.25, 0.5, 0.75)
    found = sketches.quantiles(daily.withColumn("year", F.year("day")), ranks, by=["year"]).select(
        "year", "n", F.posexplode("quantiles").alias("k", "x"))
    x, of = F.col("x"), F.col("total_vnd").cast("double")
    checked = (orders.select(F.year("order_date").alias("year"), "total_vnd").filter(F.col("total_vnd").isNotNull())
               .join(F.broadcast(found), "year")  # three rows a year
               .groupBy("year", "k", "n").agg((F.count_if(of < x) / F.count(F.lit(1))).alias("low"),
                                              (F.count_if(of <= x) / F.count(F.lit(1))).alias("high")))
    rank = F.element_at(F.array(*[F.lit(r) for r in ranks]), F.col("k") + 1)
    slack = F.lit(sketches.RANK_ERROR) + 1 / F.col("n")
    return checked.select("year", rank.alias("rank"), "n",
                          ((F.col("low") - slack <= rank) & (rank <= F.col("high") + slack)).alias("within_error"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cashflow_daily": cashflow_daily,
    "payment_status": payment_status,
    "customer_journey": customer_journey,
    "cashflow_daily_stored_view": _stored_view("vw_cashflow_daily"),
    "payment_status_stored_view": _stored_view("vw_payment_status", ORDERS_AS_OF),
    "customer_journey_stored_view": _stored_view("vw_customer_journey"),
    "customer_journey_colocated": customer_journey_colocated,
    "customer_aggregates_colocated": customer_aggregates_colocated,
    "rfm_segments": rfm_segments,
    "rfm_distribution": rfm_distribution,
    "customer_aggregates": customer_aggregates,
    "dim_date": dim_date,
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "dim_locations": dim_locations,
    "dim_staff": dim_staff,
    "fact_orders_union": fact_orders_union,
    "order_items_explode": order_items_explode,
    "fact_payments": fact_payments,
    "fact_cart_events": fact_cart_events,
    "fact_bank_transactions": fact_bank_transactions,
    "dq_nulls": dq_nulls,
    "dq_duplicates": dq_duplicates,
    "dedup_first": dedup_first,
    "dq_date_range": dq_date_range,
    "dq_amounts": dq_amounts,
    "surrogate_keys": surrogate_keys,
    "date_keys": date_keys,
    "usd_to_vnd": usd_to_vnd,
    "quality_report": quality_report,
    "table_row_counts": table_row_counts,
    "measure_sales": measure_sales,
    "measure_items_revenue": measure_items_revenue,
    "measure_payments": measure_payments,
    "measure_journey": measure_journey,
    "revenue_ytd": revenue_ytd,
    "revenue_mom": revenue_mom,
    "event_funnel": event_funnel,
    "distinct_customers_ytd": distinct_customers_ytd,
    "event_funnel_passed": event_funnel_passed,
    "amount_quantiles": amount_quantiles,
}
