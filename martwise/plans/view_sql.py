"""The three serving views as SQL text (K6, V1-V3), for views that outlive a session.

The texts compute what ``plans.views`` computes, over tables named by the
caller.  A view stored in the catalog holds its text only, so it follows its
tables from version to version and serves every session and SQL client that
shares the catalog.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from martwise.functions.columns import OVERDUE_AFTER_DAYS, USD_TO_VND_RATE
from martwise.plans.views import MINUTE_MICROS, NULL_KEY_SPREAD

log = logging.getLogger("martwise.views")

CUSTOMER_JOURNEY = f"""
WITH events AS (
  SELECT customer_id, session_id, event_type, event_timestamp, product_id, source AS traffic_source, device, utm_source,
         utm_campaign, event_key, unix_micros(CAST(event_timestamp AS TIMESTAMP)) AS micros
  FROM {{fact_cart_events}} WHERE customer_id IS NOT NULL),
minutes AS (
  SELECT customer_id, floor(micros / {MINUTE_MICROS}) AS minute, count(*) AS n FROM events GROUP BY 1, 2),
-- events before each minute of a customer: a busy customer is numbered minute by minute, in many tasks
offsets AS (
  SELECT customer_id, minute,
         sum(n) OVER (PARTITION BY customer_id ORDER BY minute NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before
  FROM minutes),
numbered AS (
  SELECT *, floor(micros / {MINUTE_MICROS}) AS minute,
         row_number() OVER (PARTITION BY customer_id, floor(micros / {MINUTE_MICROS}) ORDER BY micros NULLS FIRST, event_key) AS place
  FROM events),
firsts AS (SELECT customer_id, min(event_timestamp) AS first_event FROM events GROUP BY 1),
purchases AS (
  SELECT customer_id, min(order_date) AS first_purchase_date, count(*) AS total_purchases,
         CAST(sum(total_vnd) AS BIGINT) AS total_revenue_vnd
  FROM {{fact_orders}} WHERE customer_id IS NOT NULL GROUP BY 1),
known AS (
  SELECT f.customer_id, f.first_event, c.full_name, c.customer_segment, p.first_purchase_date, p.total_purchases, p.total_revenue_vnd
  FROM firsts f LEFT JOIN {{dim_customers}} c ON f.customer_id = c.customer_id
  LEFT JOIN purchases p ON f.customer_id = p.customer_id)
SELECT e.customer_id, k.full_name, k.customer_segment, e.session_id, e.event_type, e.event_timestamp,
       CAST(o.before + e.place AS BIGINT) AS touchpoint_sequence, e.product_id, e.traffic_source, e.device, e.utm_source,
       e.utm_campaign, k.first_purchase_date, k.total_purchases, k.total_revenue_vnd,
       timestampdiff(DAY, k.first_event, k.first_purchase_date) AS days_to_first_purchase
FROM numbered e JOIN offsets o ON e.customer_id = o.customer_id AND e.minute <=> o.minute
LEFT JOIN known k ON e.customer_id = k.customer_id
"""

CASHFLOW_DAILY = f"""
WITH sales AS (
  SELECT to_date(order_date) AS day, CAST(sum(total_vnd) AS BIGINT) AS revenue, count(*) AS orders
  FROM {{fact_orders}} WHERE status NOT IN ('cancelled', 'refunded') GROUP BY 1),
receipts AS (
  SELECT to_date(payment_date) AS day, CAST(sum(IF(payment_status = 'success', amount_vnd, 0)) AS BIGINT) AS received,
         count_if(payment_status = 'success') AS paid, count_if(payment_status <> 'success') AS failed
  FROM {{fact_payments}} GROUP BY 1),
moves AS (
  SELECT to_date(transaction_date) AS day,
         coalesce(nullif(amount_vnd, 0), try_cast(round(amount_usd * {USD_TO_VND_RATE}) AS BIGINT)) AS amount
  FROM {{fact_bank_transactions}} WHERE status IN ('posted', 'pending')),
bank AS (
  SELECT day, CAST(sum(IF(amount > 0, amount, 0)) AS BIGINT) AS inflow, CAST(sum(IF(amount < 0, abs(amount), 0)) AS BIGINT) AS outflow
  FROM moves GROUP BY 1),
traded AS (
  SELECT coalesce(s.day, r.day) AS day, revenue, orders, received, paid, failed FROM sales s FULL JOIN receipts r ON s.day = r.day)
SELECT coalesce(t.day, b.day) AS report_date, coalesce(revenue, 0) AS sales_revenue_vnd, coalesce(orders, 0) AS order_count,
       coalesce(received, 0) AS payments_received_vnd, coalesce(paid, 0) AS successful_payments, coalesce(failed, 0) AS failed_payments,
       coalesce(inflow, 0) AS bank_inflow_vnd, coalesce(outflow, 0) AS bank_outflow_vnd,
       coalesce(revenue, 0) - coalesce(outflow, 0) AS net_cashflow_vnd
FROM traded t FULL JOIN bank b ON t.day = b.day
"""

PAYMENT_STATUS = f"""
WITH orders AS (
  SELECT *, IF(trim(transaction_id) = '' OR transaction_id IS NULL, concat('\\0', order_key), transaction_id) AS pay_id,
         IF(customer_id IS NULL, pmod(xxhash64(order_key), {NULL_KEY_SPREAD}), 0) AS spread,
         timestampdiff(DAY, order_date, {{now}}) AS age
  FROM {{fact_orders}}),
customers AS (SELECT customer_id, full_name, email, CAST(0 AS BIGINT) AS spread FROM {{dim_customers}}),
payments AS (
  SELECT transaction_id AS pay_id, payment_key, payment_date, payment_status AS gateway_status, amount_vnd
  FROM {{fact_payments}} WHERE trim(transaction_id) <> ''),
joined AS (
  SELECT o.*, c.full_name, c.email, p.payment_key, p.payment_date, p.gateway_status, p.amount_vnd AS paid, p.payment_date IS NULL AS unpaid
  FROM orders o LEFT JOIN customers c ON o.customer_id = c.customer_id AND o.spread = c.spread
  LEFT JOIN payments p ON o.pay_id = p.pay_id)
SELECT order_key, order_id, order_number, customer_id, full_name AS customer_name, email AS customer_email, order_date, channel,
       total_vnd, payment_status AS order_payment_status, payment_gateway, payment_key, payment_date,
       gateway_status AS gateway_payment_status, paid AS paid_amount_vnd,
       CASE WHEN gateway_status = 'success' THEN 'Paid' WHEN gateway_status = 'failed' THEN 'Failed'
            WHEN unpaid AND age > {OVERDUE_AFTER_DAYS} THEN 'Overdue' WHEN unpaid THEN 'Pending' ELSE 'Unknown' END AS payment_status_category,
       CASE WHEN NOT unpaid THEN timestampdiff(HOUR, order_date, payment_date) END AS payment_delay_hours,
       CASE WHEN gateway_status <> 'success' OR gateway_status IS NULL THEN total_vnd - coalesce(paid, 0) ELSE 0 END AS outstanding_amount_vnd,
       CASE WHEN unpaid AND age > {OVERDUE_AFTER_DAYS} THEN age ELSE 0 END AS days_overdue
FROM joined
"""

VIEWS = {"vw_customer_journey": CUSTOMER_JOURNEY, "vw_cashflow_daily": CASHFLOW_DAILY, "vw_payment_status": PAYMENT_STATUS}
TABLES = ("fact_orders", "fact_payments", "fact_cart_events", "fact_bank_transactions", "dim_customers")


def now_sql(as_of=None) -> str:
    """P34 in SQL: a fixed run time, or the time of each query."""
    return "localtimestamp()" if as_of is None else f"TIMESTAMP_NTZ '{as_of}'"


def view_sql(name: str, tables: dict[str, str], as_of=None) -> str:
    """The text of a view over tables by their names."""
    return VIEWS[name].format(now=now_sql(as_of), **tables)


def run_view(spark: SparkSession, name: str, frames: dict[str, DataFrame], as_of=None) -> DataFrame:
    """A view's text over frames, without any name in the catalog."""
    text = VIEWS[name].replace("{now}", now_sql(as_of))
    return spark.sql(text, **{t: f for t, f in frames.items() if "{" + t + "}" in text})


def store_views(spark: SparkSession, database: str, as_of=None, names=tuple(VIEWS)) -> dict[str, bool]:
    """K6: create or replace the views in ``database``, over its tables of the gold names.

    The catalog analyses a text as it stores it; one that fails is logged and
    skipped, and the view that was there stays.
    """
    tables = {t: f"`{database}`.`{t}`" for t in TABLES}
    done = {}
    for name in names:
        try:
            spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {view_sql(name, tables, as_of)}")
            done[name] = True
        except Exception as ex:  # keep going, like the source did
            log.error("view %s failed: %s", name, ex)
            done[name] = False
    return done
