"""Raw JSON fixtures in the exports' layout, written as gzip files.

Records follow the test literals of the source system (FIXTURES.md part
A) plus the edge rows it lists: blank and null ids, bad and mixed dates,
duplicate keys with different payload, null / empty line items, items
without totals, quantity null, prices "1.9" and "x", a missing result
code, bank rows with VND 0 and negative USD, null order status.
"""

from __future__ import annotations

import gzip
import json
import os

CUSTOMERS_1 = [
    {"id": 1, "email": "a@x.vn", "name": "An", "phone": "0901", "city": "HCM", "country": "VN",
     "created_at": "2025-01-15T10:30:00Z"},
    {"id": 2, "email": None, "name": "Binh", "phone": "0902", "city": "HN", "country": "VN",
     "created_at": "2025-06-20T15:00:00+07:00"},
]
CUSTOMERS_2 = [
    {"id": 2, "email": "late@x.vn", "name": "Binh later", "city": "HN", "country": "VN", "created_at": "bad date"},
    {"id": 3, "email": "c@x.vn", "name": "Chi", "city": "DN", "country": "VN", "created_at": "2025-02-01"},
]
PRODUCTS = [
    {"id": 10, "name": "Tea", "sku": "T-1", "barcode": "893", "category": "drink", "brand": "B",
     "price_vnd": 50000, "price_usd": 2.0, "stock_quantity": 7},
    {"id": 11, "name": "Cup", "sku": "C-1", "price_vnd": "x", "price_usd": "1.9"},
]
LOCATIONS = [{"id": 1, "code": "HCM01", "name": "Store 1", "address": "1 Le Loi", "city": "HCM", "phone": "028"}]

SHOPIFY = [
    {"id": 1001, "order_number": "#1001", "transaction_id": "TX1", "customer_id": 1,
     "order_date": "2025-01-15T10:30:00Z", "payment_gateway": "paypal", "payment_status": "paid",
     "total_vnd": 1000000, "total_usd": 40.0, "source": "shopify", "status": "completed",
     "line_items": [{"product_id": 10, "name": "Tea", "quantity": 1, "price_vnd": 400000},
                    {"product_id": 11, "name": "Cup", "quantity": 2, "price_vnd": 300000,
                     "line_total_vnd": 600000}]},
    {"id": 1002, "order_number": "#1002", "transaction_id": "", "customer_id": 1,
     "order_date": "2025-01-16", "total_vnd": "2000000", "line_items": None},
]
SAPO = [
    {"id": 2001, "code": "SON2001", "total_vnd": 500000, "source": "pos", "customer": {"id": 2},
     "customer_id": 99, "staff": {"id": 7, "code": "S7", "name": "Lan", "email": "l@x.vn", "phone": "09"},
     "location_id": 1, "status": None, "payment_method": "cash", "transaction_id": "TX3",
     "created_at": "2025-02-01T09:00:00+07:00",
     "line_items": [{"id": 10, "product_name": "Tea", "quantity": None, "price": "1.9"}]},
    {"id": 2002, "code": "SON2002", "total_vnd": 100, "customer": {"id": 2},
     "staff": None, "staff_member": {"id": 8, "name": "Minh", "position": "Manager"}, "location_id": 1,
     "status": "cancelled", "created_at": "2025-02-02T09:00:00+07:00", "line_items": []},
    {"id": 2003, "code": "SON2003", "total_vnd": 100, "customer": {"id": 2},
     "staff": {"id": 7, "name": "Lan again"}, "location_id": 2, "status": "completed",
     "created_at": "2025-02-03T09:00:00+07:00"},
    {"id": 2004, "code": "SON2004", "total_vnd": 100, "staff": {"id": 0, "name": "nobody"},
     "status": "completed", "created_at": "2025-02-03T09:00:00+07:00"},
]
ONLINE = [
    {"id": 3001, "created_at": "2025-03-01T08:00:00Z", "total": 750000, "channel": "lazada",
     "customer": {"id": 3}, "payment_method": "cod", "status": "pending", "transaction_id": "TX4",
     "line_items": [{"id": 11, "name": "Cup", "quantity": 3, "unit_price": "x", "line_total": 0}]},
]
PAYPAL = [
    {"transaction_id": "TX1", "order_id": "1001", "customer_id": 1,
     "transaction_amount": {"currency_code": "USD", "value": "40.00"}, "transaction_amount_vnd": 1000000,
     "transaction_status": "COMPLETED", "transaction_initiation_date": "2025-01-15T11:00:00Z"},
    {"transaction_id": "", "order_id": "x", "transaction_amount_vnd": 5, "transaction_status": "PENDING",
     "transaction_initiation_date": "2025-01-15T11:00:00Z"},
    {"transaction_id": "", "order_id": "y", "transaction_amount_vnd": 6, "transaction_status": "PENDING",
     "transaction_initiation_date": "2025-01-15T11:00:00Z"},
]
MOMO = [
    {"transaction_id": "TX3", "orderId": "2001", "transId": 1, "amount": 500000, "resultCode": 0,
     "message": "ok", "payType": "qr", "responseTimeISO": "2025-02-01T10:00:00+07:00"},
    {"transaction_id": "TX5", "orderId": "2005", "transId": 2, "amount": 100, "message": "no code",
     "responseTimeISO": "2025-02-01T10:00:00+07:00"},
    {"transaction_id": "TX3", "orderId": "dup", "transId": 3, "amount": 1, "resultCode": 1006,
     "responseTimeISO": "2025-02-02T10:00:00+07:00"},
]
ZALOPAY = [
    {"transaction_id": "TX4", "app_trans_id": "3001", "zp_trans_id": 9, "amount": 750000, "return_code": 1,
     "channel": 36, "bank_code": "VCB", "server_time_iso": "2025-03-01T09:00:00Z"},
]
MERCURY = [
    {"transaction_id": "M1", "accountId": "A1", "amount": -12.5, "amount_usd": -12.5, "amount_vnd": 0,
     "kind": "outgoing", "status": "posted", "bankDescription": "rent", "createdAt": "2025-01-20T00:00:00Z",
     "details": {"counterpartyName": "Landlord"}, "source": "mercury"},
    {"transaction_id": "M2", "accountId": "A1", "amount": 3.0, "amount_vnd": 80000, "kind": "outgoing",
     "status": "pending", "postedAt": "2025-01-21T00:00:00Z"},
    {"transaction_id": "M2", "accountId": "A1", "amount": 999.0, "amount_vnd": 1, "kind": "dup",
     "status": "pending", "postedAt": "2025-01-22T00:00:00Z"},
]
CART = [
    {"event_id": "e1", "event_type": "view_item", "session_id": "s1", "customer_id": 1, "product_id": 10,
     "timestamp": "2025-01-15T10:00:00Z", "source": "web", "device": "mobile", "browser": "chrome",
     "utm_source": "google", "utm_campaign": "tet"},
    {"event_id": "e2", "event_type": "add_to_cart", "session_id": "s1", "customer_id": 1, "product_id": 10,
     "timestamp": "2025-01-15T10:05:00Z"},
    {"event_id": "e2", "event_type": "add_to_cart", "session_id": "s1", "customer_id": 1, "product_id": 10,
     "timestamp": "2025-01-15T10:05:00Z"},
    {"event_id": None, "event_type": "page_view", "session_id": "s2", "timestamp": "2025-01-15T11:00:00Z"},
    {"event_id": None, "event_type": "page_view", "session_id": "s2", "timestamp": "2025-01-15T11:00:00Z"},
]


def write_json_gz(path: str, records) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        json.dump(records, f)


def write_exports(root: str) -> str:
    """All sources in the exports' layout under ``root``."""
    for i in range(5):
        write_json_gz(f"{root}/shopify/orders_batch_{i}.json.gz", SHOPIFY if i == 0 else [])
    write_json_gz(f"{root}/shared/customers/customers_batch_0.json.gz", CUSTOMERS_1)
    write_json_gz(f"{root}/shared/customers/customers_batch_1.json.gz", CUSTOMERS_2)
    for i in range(2, 10):
        write_json_gz(f"{root}/shared/customers/customers_batch_{i}.json.gz", [])
    write_json_gz(f"{root}/sapo/transactions.json.gz", SAPO)
    write_json_gz(f"{root}/shared/products.json.gz", PRODUCTS)
    write_json_gz(f"{root}/shared/sapo_locations.json.gz", LOCATIONS[0])  # one object, not an array
    write_json_gz(f"{root}/online_orders/online_orders.json.gz", ONLINE)
    write_json_gz(f"{root}/paypal/transactions.json.gz", PAYPAL)
    write_json_gz(f"{root}/momo/transactions.json.gz", MOMO)
    write_json_gz(f"{root}/zalopay/transactions.json.gz", ZALOPAY)
    write_json_gz(f"{root}/mercury/transactions.json.gz", MERCURY)
    write_json_gz(f"{root}/mercury/accounts.json.gz", [{"id": "A1", "name": "Ops"}])
    write_json_gz(f"{root}/cart_tracking/cart_events.json.gz", CART)
    return root
