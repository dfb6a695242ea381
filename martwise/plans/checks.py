"""The quality checks of the gold tables, stated once (DQ1-DQ4), and the part of
them that is observed while a table is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise.functions.columns import as_of_literal
from martwise.operators.quality import DEFAULT_MIN_DATE

NULL_COLUMNS = {
    "fact_orders": ["order_id", "customer_id", "total_vnd"],
    "fact_order_items": ["order_key", "product_id"],
    "fact_payments": ["transaction_id", "amount_vnd"],
    "fact_cart_events": ["event_id", "event_type", "session_id"],
    "fact_bank_transactions": ["transaction_id", "account_id", "amount_vnd"],
    "dim_customers": ["customer_id", "email"],
    "dim_products": ["product_id", "product_name", "sku"],
    "dim_locations": ["location_id", "location_name"],
}
DUPLICATE_KEYS = {
    "fact_orders": "order_key", "fact_payments": "payment_key", "fact_cart_events": "event_key",
    "fact_bank_transactions": "transaction_key", "dim_customers": "customer_id", "dim_products": "product_id",
    "dim_locations": "location_id",
}
DATE_COLUMNS = {
    "fact_orders": "order_date", "fact_payments": "payment_date", "fact_cart_events": "event_timestamp",
    "fact_bank_transactions": "transaction_date", "dim_customers": "created_at",
}
AMOUNTS = {  # columns, and whether negative values are usual
    "fact_orders": (["total_vnd"], False),
    "fact_order_items": (["unit_price_vnd", "line_total_vnd"], False),
    "fact_payments": (["amount_vnd"], False),
    "fact_bank_transactions": (["amount_vnd", "amount_usd"], True),
    "dim_products": (["price_vnd", "price_usd"], False),
}
BLANK_IDS = {"fact_orders": "order_id", "fact_payments": "transaction_id", "fact_cart_events": "event_id",
             "fact_bank_transactions": "transaction_id"}

REPORT = "table_name string, check_name string, column_name string, value double"


def observed(name: str, columns: list[str], as_of=None, min_date: str = DEFAULT_MIN_DATE) -> dict[tuple[str, str], Column]:
    """(check, column) to the aggregate that a write of the table observes: nulls (DQ1), dates out of range and in the
    future (DQ3), blank ids (Q22).  They are sums of one pass, so the write itself takes them."""
    out = {("nulls", c): F.count_if(F.col(c).isNull()) for c in NULL_COLUMNS.get(name, ()) if c in columns}
    c = DATE_COLUMNS.get(name)
    if c in columns:
        now = as_of_literal(as_of)
        d = F.col(c).cast("timestamp_ntz")
        late = F.date_add(F.to_date(now), 1).cast("timestamp_ntz")
        out["out_of_range_count", c] = F.count_if((d < F.lit(min_date).cast("timestamp_ntz")) | (d > late))
        out["future_count", c] = F.count_if(d > now)
    c = BLANK_IDS.get(name)
    if c in columns:
        out["blank_ids", c] = F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""))
    return out


def observed_report(spark: SparkSession, found: dict[str, dict[tuple[str, str], int]]) -> DataFrame:
    """What the writes observed, as rows of the long report."""
    rows = [(table, check, column, float(n)) for table, values in found.items() for (check, column), n in values.items()]
    return spark.createDataFrame(rows, REPORT)
