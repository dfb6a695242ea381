"""Gold tables from raw inputs.

``GoldBase`` wires raw-record accessors to the builders; a subclass says
where raw records come from:

* ``RawJsonGold``: the gzip JSON exports (S1-S16), the production path.
* ``DriverGold``: the driver's Parquet tables through the adapters of
  ``sources.driver_tables`` (queries, tests, bench).

Every table is a lazy plan; a query only pulls the tables it uses, and
Catalyst prunes unused columns down to the scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise import schemas
from martwise.plans import dimensions, facts
from martwise.sources import driver_tables as dt
from martwise.sources import json_sources as js

# Fixed run times for the driver data: orders end 2001-08-01, events in
# January 2024.
ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
# In the RFM queries the orders of a customer whose key is a multiple of this
# count for the next customer, so customers without orders ("New") occur.
RFM_PASS_ON = 11

GOLD_NAMES = ("dim_customers", "dim_products", "dim_locations", "dim_staff", "dim_date",
              "fact_orders", "fact_order_items", "fact_payments", "fact_cart_events",
              "fact_bank_transactions")


class GoldBase:
    """Gold tables built from raw accessors (``raw_*``) a subclass provides."""

    spark: SparkSession

    # raw accessors --------------------------------------------------------
    @property
    def raw_orders(self) -> DataFrame | None:  # tagged union of the order sources
        raise NotImplementedError

    @property
    def raw_order_lines(self) -> DataFrame | None:  # records that carry line_items
        return self.raw_orders

    @property
    def raw_pos_orders(self) -> DataFrame | None:  # orders that may name staff
        return self.raw_orders

    @property
    def raw_payments(self) -> DataFrame | None:  # tagged union of the gateways
        raise NotImplementedError

    @property
    def raw_cart_events(self) -> DataFrame | None:
        raise NotImplementedError

    @property
    def raw_bank_transactions(self) -> DataFrame | None:
        raise NotImplementedError

    @property
    def raw_customers(self) -> DataFrame | None:
        raise NotImplementedError

    @property
    def raw_products(self) -> DataFrame | None:
        raise NotImplementedError

    @property
    def raw_locations(self) -> DataFrame | None:
        raise NotImplementedError

    # gold tables ----------------------------------------------------------
    def _or_empty(self, df: DataFrame | None, name: str) -> DataFrame:
        return df if df is not None else self.spark.createDataFrame([], schemas.GOLD[name])

    @cached_property
    def fact_orders(self) -> DataFrame:
        r = self.raw_orders
        return self._or_empty(r if r is None else facts.fact_orders_from_raw(r), "fact_orders")

    @cached_property
    def fact_order_items(self) -> DataFrame:
        r = self.raw_order_lines
        return self._or_empty(r if r is None else facts.fact_order_items_from_raw(r), "fact_order_items")

    @cached_property
    def fact_payments(self) -> DataFrame:
        r = self.raw_payments
        return self._or_empty(r if r is None else facts.fact_payments_from_raw(r), "fact_payments")

    @cached_property
    def fact_cart_events(self) -> DataFrame:
        r = self.raw_cart_events
        return self._or_empty(r if r is None else facts.fact_cart_events(r), "fact_cart_events")

    @cached_property
    def fact_bank_transactions(self) -> DataFrame:
        r = self.raw_bank_transactions
        return self._or_empty(r if r is None else facts.fact_bank_transactions(r), "fact_bank_transactions")

    @cached_property
    def dim_customers(self) -> DataFrame:
        r = self.raw_customers
        return self._or_empty(r if r is None else dimensions.dim_customers(r), "dim_customers")

    @cached_property
    def dim_products(self) -> DataFrame:
        r = self.raw_products
        return self._or_empty(r if r is None else dimensions.dim_products(r), "dim_products")

    @cached_property
    def dim_locations(self) -> DataFrame:
        r = self.raw_locations
        return self._or_empty(r if r is None else dimensions.dim_locations(r), "dim_locations")

    @cached_property
    def dim_staff(self) -> DataFrame:
        return self._or_empty(dimensions.dim_staff(self.raw_pos_orders), "dim_staff")

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date_spanning(self.fact_orders, "order_date")

    def all_tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in GOLD_NAMES}

    def raw_for(self, name: str) -> DataFrame | None:
        """The raw frame a gold table is built from: empty when the table is
        (a cheap emptiness probe for the sinks, K2).  Only dim_staff can be
        empty with a non-empty input (no order names a staff member); it is
        then written empty rather than skipped."""
        return {
            "fact_orders": self.raw_orders, "fact_order_items": self.raw_order_lines,
            "fact_payments": self.raw_payments, "fact_cart_events": self.raw_cart_events,
            "fact_bank_transactions": self.raw_bank_transactions, "dim_customers": self.raw_customers,
            "dim_products": self.raw_products, "dim_locations": self.raw_locations,
            "dim_staff": self.raw_pos_orders, "dim_date": self.raw_orders,
        }[name]


class DriverGold(GoldBase):
    """Gold tables from the driver's Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each driver table is read once per instance, so every gold table
        built from it shares one scan node (and Spark can reuse its
        exchanges within a query)."""
        if name not in self._tables:
            self._tables[name] = dt.load(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def raw_orders(self) -> DataFrame:
        return dt.raw_orders(self.table("orders"))

    @cached_property
    def raw_order_lines(self) -> DataFrame:
        return dt.raw_order_fragments(self.table("lineitem"), self.table("orders"))

    @cached_property
    def raw_payments(self) -> DataFrame:
        return dt.raw_payments(self.table("orders"))

    @cached_property
    def raw_cart_events(self) -> DataFrame:
        return dt.raw_cart_events(self.table("events"))

    @cached_property
    def raw_bank_transactions(self) -> DataFrame:
        return dt.raw_mercury_transactions(self.table("customer"))

    @cached_property
    def raw_customers(self) -> DataFrame:
        return dt.raw_customers(self.table("customer"))

    @cached_property
    def raw_products(self) -> DataFrame:
        return dt.raw_products(self.table("part"))

    @cached_property
    def raw_locations(self) -> DataFrame:
        return dt.raw_locations(self.table("nation"), self.table("region"))

    @cached_property
    def rfm_orders(self) -> DataFrame:
        c = F.col("customer_id")
        return self.fact_orders.withColumn("customer_id", F.when(c % RFM_PASS_ON == 0, c + 1).otherwise(c))


class RawJsonGold(GoldBase):
    """Gold tables from the gzip JSON exports under ``root`` (any Hadoop
    path).  A source none of whose files exist reads as absent, like an
    empty export; a partial set of batch files is an error.  With
    ``bronze`` set, large single-file sources are landed once as Parquet
    there and read back (H1)."""

    def __init__(self, spark: SparkSession, root: str, bronze: str | None = None,
                 land: tuple[str, ...] = ("cart_events",)):
        self.spark = spark
        self.root = root
        self.bronze = bronze
        self.land = land

    def source(self, name: str) -> DataFrame | None:
        df = js.read_source_if_present(self.spark, self.root, name)
        if df is None:
            return None
        if self.bronze and name in self.land:
            df = js.land_bronze(df, f"{self.bronze.rstrip('/')}/{name}")
        return df

    @cached_property
    def raw_orders(self) -> DataFrame | None:
        return js.tag_union({"shopify": self.source("shopify_orders"), "sapo_pos": self.source("sapo_orders"),
                             "online": self.source("online_orders")}, schemas.RAW_ORDER)

    @cached_property
    def raw_pos_orders(self) -> DataFrame | None:
        return self.source("sapo_orders")

    @cached_property
    def raw_payments(self) -> DataFrame | None:
        return js.tag_union({"paypal": self.source("paypal"), "momo": self.source("momo"),
                             "zalopay": self.source("zalopay")}, schemas.RAW_PAYMENT_ANY)

    @cached_property
    def raw_cart_events(self) -> DataFrame | None:
        return self.source("cart_events")

    @cached_property
    def raw_bank_transactions(self) -> DataFrame | None:
        return self.source("mercury_transactions")

    @cached_property
    def raw_customers(self) -> DataFrame | None:
        return self.source("customers")

    @cached_property
    def raw_products(self) -> DataFrame | None:
        return self.source("products")

    @cached_property
    def raw_locations(self) -> DataFrame | None:
        return self.source("locations")

    @cached_property
    def dim_date(self) -> DataFrame:
        """The default calendar, whether or not there are orders."""
        return dimensions.dim_date(self.spark)

    def raw_for(self, name: str) -> DataFrame | None:
        return self.dim_date if name == "dim_date" else super().raw_for(name)
