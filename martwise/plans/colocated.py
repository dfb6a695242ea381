"""V1 and B12 over gold tables co-located on the customer (``sinks.buckets``).

The customers in buckets are joined, grouped and numbered bucket beside
bucket: no table is shuffled for it.  The hot customers, fewer than there
are buckets, take the way of ``plans.views``, which splits a customer over
many tasks.  Both give what the functions over plain tables give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwise.functions.columns import whole_days
from martwise.operators import rfm
from martwise.plans import views
from martwise.plans.gold import GoldBase
from martwise.sinks.buckets import HOT_ROWS, Colocated, open_colocated, publish_colocated
from martwise.sinks.tables import write_table

KEY = "customer_id"
# Columns that order the rows of a customer within a bucket.
SORTED = {"fact_cart_events": ("event_timestamp", "event_key"), "fact_orders": ("order_date",), "dim_customers": ()}


def colocate_gold(tables: dict[str, DataFrame], database: str, buckets: int, root: str | None = None,
                  hot_rows: int = HOT_ROWS, prefix: str = "by_customer_") -> dict[str, Colocated]:
    """Publish the gold tables that the customer joins as ``<prefix><name>`` and open them."""
    out = {}
    for name in SORTED:
        if name in tables:
            table = f"{database}.{prefix}{name}"
            publish_colocated(tables[name], table, KEY, buckets, SORTED[name], root, hot_rows)
            out[name] = open_colocated(tables[name].sparkSession, table)
    return out


def open_gold(spark: SparkSession, database: str, prefix: str = "by_customer_") -> dict[str, Colocated]:
    """The co-located tables that ``colocate_gold`` has published."""
    return {name: open_colocated(spark, f"{database}.{prefix}{name}") for name in SORTED}


def _each_once(customers: Colocated) -> None:
    if not customers.hot_keys.isEmpty():
        raise ValueError("the dimension holds a customer more often than a bucket has rows")


def _by_both(left: DataFrame, bucketed: DataFrame, hot: DataFrame) -> DataFrame:
    """``left`` with the aggregates of its customer, from the buckets or, for
    the few hot ones, from a broadcast; a customer is in one of them only."""
    columns = [c for c in bucketed.columns if c != KEY]
    hot = hot.select(KEY, *[F.col(c).alias(f"{c}_hot") for c in columns])
    joined = left.join(bucketed, KEY, "left").join(F.broadcast(hot), KEY, "left")
    return joined.select(*left.columns, *[F.coalesce(c, f"{c}_hot").alias(c) for c in columns])


def _journey_in_buckets(events: Colocated, customers: Colocated, orders: Colocated) -> DataFrame:
    ev = views.journey_events(events.rows)
    own = Window.partitionBy(KEY)
    ordered = own.orderBy(F.col("event_timestamp").asc_nulls_first(), F.col("event_key").asc_nulls_first())
    numbered = ev.withColumns({"touchpoint_sequence": F.row_number().over(ordered).cast("bigint"),
                               "_first_event": F.min("event_timestamp").over(own)})
    named = numbered.join(customers.rows.select(KEY, "full_name", "customer_segment"), KEY, "left")
    return _by_both(named, views.journey_purchases(orders.rows), views.journey_purchases(orders.hot)) \
        .withColumn("days_to_first_purchase", whole_days("_first_event", "first_purchase_date"))


def customer_journey(events: Colocated, customers: Colocated, orders: Colocated) -> DataFrame:
    """V1.  A customer in buckets has at most a bucket's rows: a plain window
    numbers them.  The dimension holds each customer once (an error if it has hot ones)."""
    _each_once(customers)
    hot = views.customer_journey(events.hot, customers.of_hot_keys_of(events), orders.of_hot_keys_of(events))
    return _journey_in_buckets(events, customers, orders).select(*hot.columns).unionByName(hot)


def _customers_in_buckets(customers: Colocated, orders: Colocated) -> DataFrame:
    base = customers.rows.drop(*rfm.AGGREGATE_COLUMNS, "customer_segment")
    return _by_both(base, rfm.order_aggregates(orders.rows), rfm.order_aggregates(orders.hot))


def update_customer_aggregates(customers: Colocated, orders: Colocated, as_of=None, method: str = "qcut") -> DataFrame:
    """B12.  Customers without an id have no orders and are new."""
    _each_once(customers)
    known = rfm.with_segments(_customers_in_buckets(customers, orders), as_of, method, customers.buckets)
    base = customers.hot.drop(*rfm.AGGREGATE_COLUMNS, "customer_segment")
    zero, never = F.lit(0).cast("bigint"), F.lit(None)
    types = {f.name: f.dataType for f in known.schema}
    unknown = base.withColumns({
        "lifetime_value_vnd": zero, "total_orders": zero, "customer_segment": F.lit(rfm.NEW_SEGMENT),
        **{c: never.cast(types[c]) for c in ("first_order_date", "last_order_date")}})
    return known.unionByName(unknown.select(*known.columns))


def gold_by_customer(gold: GoldBase, frames: dict[str, DataFrame], scratch: str, buckets: int,
                     hot_rows: int = HOT_ROWS) -> dict[str, Colocated]:
    """``frames``, gold tables of ``gold`` by their names, written plainly below ``scratch``, then co-located
    there under names of this folder's own."""
    spark, tables = gold.spark, {}
    for name, frame in frames.items():
        rows = write_table(frame, f"{scratch}/gold/{name}", empty_probe=gold.raw_for(name))
        tables[name] = spark.read.schema(frame.schema).parquet(f"{scratch}/gold/{name}") if rows \
            else spark.createDataFrame([], frame.schema)
    tag = scratch.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    return colocate_gold(tables, spark.catalog.currentDatabase(), buckets, scratch, hot_rows, f"{tag}_")
