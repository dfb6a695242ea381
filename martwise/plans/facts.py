"""Fact builders B6-B11.

Each builder has a public form taking one raw frame per source (None when
a source is absent) and a ``*_from_raw`` core taking their tagged union
(column ``_source``), which is what one-pass adapters produce.  Per-source
rules become per-row CASE expressions over the tag, so the union is one
plan and one scan, not one job per source.  Builders are lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwise import schemas
from martwise.functions.columns import (
    blank_to_null, code_status, conform, date_key, line_total, parse_utc_timestamp, rename_existing,
    standardize_columns, surrogate_key, to_double_or_zero, to_long_or_zero, to_nullable_long,
    usd_to_vnd_fill, zalopay_method,
)
from martwise.operators.dedup import keep_first, keep_first_with_id
from martwise.sources.json_sources import SEQ, SEQ_TYPE, TAG, conform_raw, tag_union

ORDER_SOURCES = ("shopify", "sapo_pos", "online")
PAYMENT_GATEWAYS = ("paypal", "momo", "zalopay")


def _priority(names: tuple[str, ...]) -> Column:
    """Source order of the union: the first source's record wins a tie."""
    expr = None
    for i, n in enumerate(names):
        expr = F.when(F.col(TAG) == n, F.lit(i)) if expr is None else expr.when(F.col(TAG) == n, F.lit(i))
    return expr


# -- orders ------------------------------------------------------------------

def _order_header(raw: DataFrame) -> dict[str, Column]:
    """The order-level fields of every source."""
    src = F.col(TAG)
    shop, sapo, online = src == "shopify", src == "sapo_pos", src == "online"
    cust_struct = F.col("customer.id")
    return {
        "order_id": F.coalesce(F.col("id"), F.col("order_id")),
        "order_number": F.when(sapo, F.coalesce(F.col("code"), F.col("order_number")))
                         .otherwise(F.col("order_number")),
        "transaction_id": F.col("transaction_id"),
        "customer_id": to_nullable_long(F.when(sapo, F.coalesce(cust_struct, F.col("customer_id")))
                                        .otherwise(F.coalesce(F.col("customer_id"), cust_struct))),
        "location_id": to_nullable_long(F.col("location_id")),
        "order_date_text": F.coalesce(F.col("order_date"), F.col("created_at")),
        "channel": F.when(shop, F.lit("shopify")).when(sapo, F.lit("sapo_pos"))
                    .otherwise(F.coalesce(F.col("channel"), F.lit("online"))),
        "source": F.coalesce(F.col("source"), F.when(shop, "shopify").when(sapo, "sapo_pos")
                             .otherwise("online")),
        "status": F.col("status"),
        "payment_status": F.when(shop, F.col("payment_status"))
                           .otherwise(F.coalesce(F.col("payment_status"), F.col("status"))),
        "payment_gateway": F.when(shop, F.col("payment_gateway"))
                            .otherwise(F.coalesce(F.col("payment_gateway"), F.col("payment_method"))),
        "payment_method": F.col("payment_method"),
        "total_vnd_text": F.when(online, F.coalesce(F.col("total_vnd"), F.col("total")))
                           .otherwise(F.col("total_vnd")),
        "total_usd_text": F.col("total_usd"),
    }


def fact_orders(shopify: DataFrame | None = None, sapo: DataFrame | None = None,
                online: DataFrame | None = None) -> DataFrame:
    """Orders of all channels with one key function (Q1)."""
    return fact_orders_from_raw(tag_union({"shopify": shopify, "sapo_pos": sapo, "online": online},
                                          schemas.RAW_ORDER))


def fact_orders_from_raw(raw: DataFrame) -> DataFrame:
    h = _order_header(raw)
    df = raw.select(*[v.alias(k) for k, v in h.items()], _priority(ORDER_SOURCES).alias("_prio"),
                    F.col(SEQ))
    df = df.withColumns({
        "order_date": parse_utc_timestamp("order_date_text"),
        "total_vnd": to_long_or_zero("total_vnd_text"),
        "total_usd": to_double_or_zero("total_usd_text"),
        "order_key": surrogate_key("order_id", "source", "channel"),
    }).withColumn("order_date_key", date_key("order_date"))
    deduped = keep_first_with_id(conform(df, schemas.FACT_ORDERS, "_prio", SEQ), ["order_key"],
                                 "order_id", ["_prio", SEQ], schemas.FACT_ORDERS.fieldNames())
    return conform(deduped, schemas.FACT_ORDERS)


# -- order items -------------------------------------------------------------

def fact_order_items(shopify: DataFrame | None = None, sapo: DataFrame | None = None,
                     online: DataFrame | None = None, dedup_items: bool = False) -> DataFrame:
    """One row per line item (E1 explode with position)."""
    return fact_order_items_from_raw(tag_union({"shopify": shopify, "sapo_pos": sapo, "online": online},
                                               schemas.RAW_ORDER), dedup_items)


def fact_order_items_from_raw(raw: DataFrame, dedup_items: bool = False) -> DataFrame:
    """E1 + P16 + P21 + Q4: items inherit the order's key (Q1); the item key
    is (order key, product, position in order).  Items of a duplicated order
    are kept (Q19) unless ``dedup_items``."""
    h = _order_header(raw)
    orders = raw.select(h["order_id"].alias("order_id"), h["transaction_id"].alias("transaction_id"),
                        h["order_date_text"].alias("order_date_text"), h["source"].alias("source"),
                        h["channel"].alias("channel"), F.col(SEQ),
                        F.posexplode_outer("line_items").alias("_pos", "item"))
    # FL5: null / empty arrays and null items drop.  The outer form plus a
    # filter keeps Catalyst from inferring size(line_items) > 0 and copying
    # the array expression into an upstream join condition.
    items = orders.filter(F.col("item").isNotNull())
    it = lambda f: F.col(f"item.{f}")
    qty = to_long_or_zero(F.coalesce(it("quantity"), F.lit("1")))
    unit = to_long_or_zero(F.coalesce(it("price_vnd"), it("price"), it("unit_price")))
    total = to_long_or_zero(F.coalesce(it("line_total_vnd"), it("total"), it("line_total")))
    df = items.select(
        "order_id", "transaction_id", "_pos", F.col(SEQ),
        surrogate_key("order_id", "source", "channel").alias("order_key"),
        to_nullable_long(F.coalesce(it("product_id"), it("id"))).alias("product_id"),
        F.coalesce(it("name"), it("product_name"), F.lit("")).alias("product_name"),
        qty.alias("quantity"), unit.alias("unit_price_vnd"), total.alias("_total"),
        F.coalesce(to_nullable_long(it("line_number")), F.col("_pos") + 1).alias("_position"),
        parse_utc_timestamp("order_date_text").alias("order_date"))
    df = df.withColumns({
        "line_total_vnd": line_total("_total", "unit_price_vnd", "quantity"),
        "order_item_key": surrogate_key("order_key", "product_id", "_position"),
        "order_date_key": date_key("order_date"),
    })
    if dedup_items:
        df = keep_first(df, ["order_item_key"], [SEQ, "_pos"])
    return conform(df, schemas.FACT_ORDER_ITEMS)


# -- payments ----------------------------------------------------------------

def fact_payments(paypal: DataFrame | None = None, momo: DataFrame | None = None,
                  zalopay: DataFrame | None = None, normalise_status: bool = False) -> DataFrame:
    """Gateway records in one table."""
    return fact_payments_from_raw(tag_union({"paypal": paypal, "momo": momo, "zalopay": zalopay},
                                            schemas.RAW_PAYMENT_ANY), normalise_status)


def fact_payments_from_raw(raw: DataFrame, normalise_status: bool = False) -> DataFrame:
    """P14 P19 P20 + Q2: PayPal's status passes through raw ('COMPLETED')
    unless ``normalise_status`` maps it to success / failed."""
    g = F.col(TAG)
    pp, momo, zp = g == "paypal", g == "momo", g == "zalopay"
    pp_status = F.coalesce(F.col("transaction_status"), F.lit(""))
    if normalise_status:
        pp_status = F.when(F.upper(pp_status) == "COMPLETED", "success").otherwise("failed")
    df = raw.select(
        F.coalesce(F.col("transaction_id"), F.lit("")).alias("transaction_id"),
        F.coalesce(F.when(pp, F.col("order_id")).when(momo, F.col("orderId")).otherwise(F.col("app_trans_id")),
                   F.lit("")).alias("order_id"),
        F.when(pp, to_nullable_long("customer_id")).alias("customer_id"),
        g.alias("payment_gateway"),
        F.when(pp, F.lit("paypal")).when(momo, F.coalesce(F.col("payType"), F.lit("momo")))
         .otherwise(zalopay_method("channel")).alias("payment_method"),
        to_long_or_zero(F.when(pp, F.col("transaction_amount_vnd")).otherwise(F.col("amount"))).alias("amount_vnd"),
        F.when(pp, to_double_or_zero("transaction_amount.value")).otherwise(F.lit(0.0)).alias("amount_usd"),
        F.when(pp, pp_status).when(momo, code_status("resultCode", 0))
         .otherwise(code_status("return_code", 1)).alias("payment_status"),
        parse_utc_timestamp(F.when(pp, F.col("transaction_initiation_date"))
                            .when(momo, F.col("responseTimeISO"))
                            .otherwise(F.col("server_time_iso"))).alias("payment_date"),
        g.alias("source"), _priority(PAYMENT_GATEWAYS).alias("_prio"), F.col(SEQ))
    df = df.withColumns({"payment_key": surrogate_key("transaction_id", "payment_gateway"),
                         "payment_date_key": date_key("payment_date")})
    deduped = keep_first_with_id(conform(df, schemas.FACT_PAYMENTS, "_prio", SEQ), ["payment_key"],
                                 "transaction_id", ["_prio", SEQ], schemas.FACT_PAYMENTS.fieldNames())
    return conform(deduped, schemas.FACT_PAYMENTS)


# -- cart events -------------------------------------------------------------

def fact_cart_events(raw: DataFrame) -> DataFrame:
    """B9 (and B10: the same transform serves any slice of the input, e.g.
    one micro-batch of the stream).  Q3 fix: the key is (event_id,
    session_id) so duplicate events are really removed; records without an
    event id keep their file position in the key and are never merged."""
    df = rename_existing(standardize_columns(raw), {"timestamp": "event_timestamp_text"})
    if "event_timestamp_text" not in df.columns and "event_timestamp" in df.columns:
        df = df.withColumnRenamed("event_timestamp", "event_timestamp_text")
    fields = [f.name for f in schemas.RAW_CART_EVENT.fields if f.name != "timestamp"]
    have = set(df.columns)
    df = df.select(*[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c)
                     for c in fields + ["event_timestamp_text"]],
                   (F.col(SEQ) if SEQ in have else F.lit(None).cast(SEQ_TYPE)).alias(SEQ))
    real = blank_to_null(F.col("event_id")).isNotNull()
    df = df.withColumns({
        "event_timestamp": parse_utc_timestamp("event_timestamp_text"),
        "customer_id": to_nullable_long("customer_id"),
        "product_id": to_nullable_long("product_id"),
        "event_key": F.when(real, surrogate_key("event_id", "session_id"))
                      .otherwise(surrogate_key("event_id", "session_id", F.col(f"{SEQ}.file"),
                                               F.col(f"{SEQ}.pos"))),
    }).withColumn("event_date_key", date_key("event_timestamp"))
    deduped = keep_first_with_id(conform(df, schemas.FACT_CART_EVENTS, SEQ), ["event_key"], "event_id",
                                 [SEQ], schemas.FACT_CART_EVENTS.fieldNames())
    return conform(deduped, schemas.FACT_CART_EVENTS)


# -- bank --------------------------------------------------------------------

def fact_bank_transactions(raw: DataFrame) -> DataFrame:
    """B11 + P15 P16 P22: USD fills VND at the fixed rate when VND is 0."""
    raw = conform_raw(raw, schemas.RAW_MERCURY_TXN)  # absent fields read as null
    df = raw.select(
        F.coalesce(F.col("transaction_id"), F.lit("")).alias("transaction_id"),
        F.coalesce(F.col("accountId"), F.lit("")).alias("account_id"),
        F.coalesce(F.col("kind"), F.lit("")).alias("transaction_type"),
        to_double_or_zero(F.coalesce(F.col("amount_usd"), F.col("amount"))).alias("amount_usd"),
        to_long_or_zero(F.col("amount_vnd")).alias("_vnd"),
        F.coalesce(F.col("status"), F.lit("")).alias("status"),
        F.coalesce(F.col("bankDescription"), F.lit("")).alias("description"),
        F.coalesce(F.col("details.counterpartyName"), F.lit("")).alias("counterparty"),
        parse_utc_timestamp(F.coalesce(F.col("createdAt"), F.col("postedAt"))).alias("transaction_date"),
        F.coalesce(F.col("source"), F.lit("mercury_bank")).alias("source"),
        (F.col(SEQ) if SEQ in raw.columns else F.lit(None).cast(SEQ_TYPE)).alias(SEQ))
    df = df.withColumns({
        "amount_vnd": usd_to_vnd_fill("_vnd", "amount_usd"),
        "transaction_key": surrogate_key("transaction_id", "account_id"),
        "transaction_date_key": date_key("transaction_date"),
    })
    deduped = keep_first_with_id(conform(df, schemas.FACT_BANK_TRANSACTIONS, SEQ), ["transaction_key"],
                                 "transaction_id", [SEQ], schemas.FACT_BANK_TRANSACTIONS.fieldNames())
    return conform(deduped, schemas.FACT_BANK_TRANSACTIONS)
