"""Raw (bronze) and gold schemas.

Raw schemas read every scalar leaf as text.  Sources disagree on types
(a price may arrive as 1.9, "1.9" or "x"), and the reader turns any JSON
scalar into its text for a string field, so typing happens once, in the
builders, with explicit ``try_*`` coercions instead of per-file inference.
An explicit schema also saves the extra pass over gzip JSON that schema
inference costs.  Keys absent from a record become null.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _text_struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


def _with(struct: T.StructType, **extra: T.DataType) -> T.StructType:
    return T.StructType(list(struct.fields) + [T.StructField(k, v, True) for k, v in extra.items()])


# -- raw sources -------------------------------------------------------------

RAW_CUSTOMER = _text_struct("id", "email", "name", "phone", "city", "country", "created_at")

RAW_PRODUCT = _text_struct("id", "name", "sku", "barcode", "category", "brand",
                           "price_vnd", "price_usd", "stock_quantity")

RAW_LOCATION = _text_struct("id", "code", "name", "address", "city", "phone")

# ``line_number`` is optional: when a source states the position of an item
# inside its order it is used for the item key, else the array position is.
LINE_ITEM = _text_struct("product_id", "id", "name", "product_name", "quantity",
                         "price_vnd", "price", "unit_price", "line_total_vnd",
                         "total", "line_total", "line_number")

PERSON = _text_struct("id", "code", "name", "position", "email", "phone")

_ORDER_TEXT = ("id", "order_id", "order_number", "code", "transaction_id", "customer_id",
               "location_id", "order_date", "created_at", "channel", "source", "status",
               "payment_status", "payment_gateway", "payment_method", "total_vnd", "total",
               "total_usd")

# One order schema serves Shopify, Sapo and online exports: each fills the
# fields it has and the rest read as null.
RAW_ORDER = _with(_text_struct(*_ORDER_TEXT),
                  customer=_text_struct("id"),
                  staff=PERSON,
                  staff_member=PERSON,
                  line_items=T.ArrayType(LINE_ITEM, True))

RAW_PAYPAL = _with(_text_struct("transaction_id", "order_id", "customer_id",
                                "transaction_amount_vnd", "transaction_status",
                                "transaction_initiation_date"),
                   transaction_amount=_text_struct("currency_code", "value"))

RAW_MOMO = _text_struct("transaction_id", "orderId", "transId", "amount", "resultCode",
                        "message", "payType", "responseTimeISO")

RAW_ZALOPAY = _text_struct("transaction_id", "app_trans_id", "zp_trans_id", "amount",
                           "return_code", "channel", "bank_code", "server_time_iso")

RAW_MERCURY_TXN = _with(_text_struct("transaction_id", "accountId", "amount", "amount_usd",
                                     "amount_vnd", "kind", "status", "bankDescription",
                                     "createdAt", "postedAt", "source"),
                        details=_text_struct("counterpartyName"))

# Fields of all three gateways, for a tagged union of their records.
RAW_PAYMENT_ANY = T.StructType(
    list(RAW_PAYPAL.fields)
    + [f for f in RAW_MOMO.fields if f.name not in RAW_PAYPAL.fieldNames()]
    + [f for f in RAW_ZALOPAY.fields
       if f.name not in RAW_PAYPAL.fieldNames() and f.name not in RAW_MOMO.fieldNames()])

# Account fields are never shown by the source; these are the usual ones.
RAW_MERCURY_ACCOUNT = _text_struct("id", "name", "status", "type", "routingNumber",
                                   "accountNumber", "currentBalance", "availableBalance",
                                   "createdAt")

RAW_CART_EVENT = _text_struct("event_id", "event_type", "session_id", "customer_id",
                              "product_id", "timestamp", "source", "device", "browser",
                              "utm_source", "utm_campaign")


# -- gold tables -------------------------------------------------------------

L, I, D, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _gold(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


DIM_CUSTOMERS = _gold(("customer_id", L), ("email", S), ("full_name", S), ("phone", S),
                      ("city", S), ("country", S), ("created_at", TS),
                      ("customer_segment", S), ("lifetime_value_vnd", L),
                      ("total_orders", L), ("first_order_date", TS), ("last_order_date", TS))

DIM_PRODUCTS = _gold(("product_id", L), ("product_name", S), ("sku", S), ("barcode", S),
                     ("category", S), ("brand", S), ("price_vnd", L), ("price_usd", D),
                     ("stock_quantity", L), ("is_active", B))

DIM_LOCATIONS = _gold(("location_id", L), ("location_code", S), ("location_name", S),
                      ("location_type", S), ("city", S), ("address", S), ("phone", S),
                      ("is_active", B))

DIM_STAFF = _gold(("staff_id", L), ("staff_code", S), ("full_name", S), ("position", S),
                  ("email", S), ("phone", S), ("location_id", L), ("hire_date", TS),
                  ("is_active", B))

DIM_DATE = _gold(("date_key", I), ("full_date", DT), ("year", I), ("quarter", I),
                 ("month", I), ("month_name", S), ("week", I), ("day_of_month", I),
                 ("day_of_week", I), ("day_name", S), ("is_weekend", B),
                 ("is_holiday", B), ("fiscal_year", I), ("fiscal_quarter", I))

FACT_ORDERS = _gold(("order_key", S), ("order_id", S), ("order_number", S),
                    ("transaction_id", S), ("customer_id", L), ("location_id", L),
                    ("order_date", TS), ("order_date_key", I), ("channel", S), ("source", S),
                    ("status", S), ("payment_status", S), ("payment_gateway", S),
                    ("payment_method", S), ("total_vnd", L), ("total_usd", D))

FACT_ORDER_ITEMS = _gold(("order_item_key", S), ("order_key", S), ("order_id", S),
                         ("transaction_id", S), ("product_id", L), ("product_name", S),
                         ("quantity", L), ("unit_price_vnd", L), ("line_total_vnd", L),
                         ("order_date", TS), ("order_date_key", I))

FACT_PAYMENTS = _gold(("payment_key", S), ("transaction_id", S), ("order_id", S),
                      ("customer_id", L), ("payment_gateway", S), ("payment_method", S),
                      ("amount_vnd", L), ("amount_usd", D), ("payment_status", S),
                      ("payment_date", TS), ("payment_date_key", I), ("source", S))

FACT_CART_EVENTS = _gold(("event_key", S), ("event_id", S), ("session_id", S),
                         ("customer_id", L), ("event_type", S), ("event_timestamp", TS),
                         ("event_date_key", I), ("product_id", L), ("source", S),
                         ("device", S), ("browser", S), ("utm_source", S),
                         ("utm_campaign", S))

FACT_BANK_TRANSACTIONS = _gold(("transaction_key", S), ("transaction_id", S),
                               ("account_id", S), ("transaction_type", S), ("amount_usd", D),
                               ("amount_vnd", L), ("status", S), ("description", S),
                               ("counterparty", S), ("transaction_date", TS),
                               ("transaction_date_key", I), ("source", S))

GOLD = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "dim_locations": DIM_LOCATIONS,
    "dim_staff": DIM_STAFF,
    "dim_date": DIM_DATE,
    "fact_orders": FACT_ORDERS,
    "fact_order_items": FACT_ORDER_ITEMS,
    "fact_payments": FACT_PAYMENTS,
    "fact_cart_events": FACT_CART_EVENTS,
    "fact_bank_transactions": FACT_BANK_TRANSACTIONS,
}

# Day partition and clustering of each gold table (the warehouse layout of
# the source, re-aimed at Parquet: partition = derived day column).
LAYOUT = {
    "dim_customers": ("created_at", ()),
    "fact_orders": ("order_date", ("customer_id", "channel")),
    "fact_order_items": ("order_date", ("product_id",)),
    "fact_payments": ("payment_date", ("customer_id", "payment_gateway")),
    "fact_cart_events": ("event_timestamp", ("customer_id", "session_id", "event_type")),
    "fact_bank_transactions": ("transaction_date", ()),
}
