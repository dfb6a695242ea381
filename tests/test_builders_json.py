"""Builders B1-B12 on gzip JSON exports."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from martwise.operators import rfm
from martwise.plans import dimensions
from martwise.plans.gold import RawJsonGold
from martwise.plans.jobs import run_extract_only
from martwise.sources import json_sources as js
from tests import fixtures


def key(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16]


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = fixtures.write_exports(str(tmp_path_factory.mktemp("exports")))
    return RawJsonGold(spark, root)


def rows(df, k):
    return {r[k]: r.asDict() for r in df.collect()}


def test_extract_counts(spark, gold):
    got = {r["source"]: r["records"] for r in run_extract_only(spark, gold.root).collect()}
    assert got["shopify_orders"] == 2 and got["customers"] == 4 and got["locations"] == 1
    assert got["cart_events"] == 5 and got["mercury_accounts"] == 1


def test_dim_customers(gold):
    d = rows(gold.dim_customers, "customer_id")
    assert sorted(d) == [1, 2, 3]
    assert d[2]["full_name"] == "Binh"  # first batch file wins the duplicate
    assert d[2]["created_at"] == dt.datetime(2025, 6, 20, 8, 0)
    assert d[1]["customer_segment"] == "New" and d[1]["total_orders"] == 0
    assert d[3]["created_at"] == dt.datetime(2025, 2, 1)


def test_dim_products_and_locations(gold):
    p = rows(gold.dim_products, "product_id")
    assert p[10]["price_vnd"] == 50000 and p[10]["is_active"] is True
    assert p[11]["price_vnd"] is None and p[11]["price_usd"] == 1.9
    loc = gold.dim_locations.collect()
    assert len(loc) == 1 and loc[0]["location_type"] == "store" and loc[0]["location_code"] == "HCM01"


def test_dim_staff_first_order_wins(gold):
    s = rows(gold.dim_staff, "staff_id")
    assert sorted(s) == [7, 8]  # id 0 is not a staff member
    assert s[7]["full_name"] == "Lan" and s[7]["location_id"] == 1 and s[7]["position"] == "Staff"
    assert s[8]["position"] == "Manager" and s[8]["staff_code"] == ""


def test_dim_date_calendar(spark):
    d = dimensions.dim_date(spark, "2025-01-01", "2025-01-31").orderBy("date_key").collect()
    assert len(d) == 31 and d[0]["date_key"] == 20250101 and d[0]["is_holiday"] is True
    assert d[0]["day_of_week"] == 2 and d[0]["day_name"] == "Wednesday" and d[0]["week"] == 1
    assert dimensions.dim_date(spark).count() == 1461


def test_fact_orders_union(gold):
    o = rows(gold.fact_orders, "order_id")
    assert sorted(o) == ["1001", "1002", "2001", "2002", "2003", "2004", "3001"]
    assert o["1001"]["order_key"] == key("1001", "shopify", "shopify")
    assert o["2001"]["customer_id"] == 2  # Sapo: the customer object wins
    assert o["2001"]["source"] == "pos" and o["2001"]["channel"] == "sapo_pos"
    assert o["2001"]["payment_gateway"] == "cash" and o["2001"]["status"] is None
    assert o["2001"]["order_date"] == dt.datetime(2025, 2, 1, 2, 0)  # Q13: created_at fallback
    assert o["3001"]["channel"] == "lazada" and o["3001"]["source"] == "online"
    assert o["3001"]["total_vnd"] == 750000 and o["3001"]["payment_status"] == "pending"
    assert o["1002"]["total_vnd"] == 2000000 and o["1002"]["order_date_key"] == 20250116


def test_fact_order_items(gold):
    items = gold.fact_order_items.collect()
    by = {(r["order_id"], r["product_id"]): r for r in items}
    assert len(items) == 4  # null and empty line_items give none
    assert by[("1001", 10)]["line_total_vnd"] == 400000  # computed: price x quantity
    assert by[("1001", 11)]["quantity"] == 2 and by[("1001", 11)]["line_total_vnd"] == 600000
    sapo = by[("2001", 10)]
    assert sapo["quantity"] == 1 and sapo["unit_price_vnd"] == 1 and sapo["line_total_vnd"] == 1
    assert by[("3001", 11)]["unit_price_vnd"] == 0 and by[("3001", 11)]["line_total_vnd"] == 0
    orders = rows(gold.fact_orders, "order_id")
    assert by[("2001", 10)]["order_key"] == orders["2001"]["order_key"]  # Q1: one key function
    assert by[("1001", 10)]["order_item_key"] == key(orders["1001"]["order_key"], "10", "1")


def test_fact_payments(gold):
    p = gold.fact_payments.collect()
    assert len(p) == 6  # momo TX3 duplicate removed; blank PayPal ids both kept (Q22)
    by = {(r["payment_gateway"], r["order_id"]): r for r in p}
    assert by[("paypal", "1001")]["payment_status"] == "COMPLETED"  # Q2: raw status kept
    assert by[("paypal", "1001")]["amount_usd"] == 40.0
    assert by[("momo", "2005")]["payment_status"] == "failed"  # missing result code
    assert by[("momo", "2001")]["payment_date"] == dt.datetime(2025, 2, 1, 3, 0)
    assert by[("zalopay", "3001")]["payment_method"] == "zalopay_ch36"
    assert by[("zalopay", "3001")]["payment_status"] == "success"


def test_fact_payments_normalised_status(gold):
    from martwise.plans.facts import fact_payments_from_raw
    st = {r["order_id"]: r["payment_status"] for r in fact_payments_from_raw(gold.raw_payments, True).collect()}
    assert st["1001"] == "success" and st["x"] == "failed"


def test_fact_cart_events(gold):
    e = gold.fact_cart_events.collect()
    assert len(e) == 4  # the repeated e2 is removed (Q3); two id-less rows stay
    e1 = [r for r in e if r["event_id"] == "e1"][0]
    assert e1["event_key"] == key("e1", "s1") and e1["event_date_key"] == 20250115
    assert len({r["event_key"] for r in e}) == 4


def test_fact_bank_transactions(gold):
    b = rows(gold.fact_bank_transactions, "transaction_id")
    assert b["M1"]["amount_vnd"] == -312500  # P22: from USD, sign kept
    assert b["M1"]["counterparty"] == "Landlord"
    assert b["M2"]["amount_vnd"] == 80000 and b["M2"]["transaction_type"] == "outgoing"  # first wins
    assert b["M2"]["amount_usd"] == 3.0 and b["M2"]["source"] == "mercury_bank"
    assert b["M2"]["transaction_date"] == dt.datetime(2025, 1, 21)


def test_customer_aggregates(spark):
    dim = spark.createDataFrame([(1, "a@x"), (2, "b@x"), (3, "c@x")], "customer_id long, email string")
    for c in ("full_name", "phone", "city", "country"):
        dim = dim.withColumn(c, F.lit(None).cast("string"))
    dim = dim.withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    orders = spark.createDataFrame([
        ("k1", 1, dt.datetime(2025, 1, 1), 1_000_000), ("k2", 1, dt.datetime(2025, 2, 1), 2_000_000),
        ("k3", 2, dt.datetime(2025, 3, 1), 500_000), ("k4", None, dt.datetime(2025, 3, 1), 7)],
        "order_key string, customer_id long, order_date timestamp_ntz, total_vnd long")
    out = rows(rfm.update_customer_aggregates(dim, orders, as_of="2025-04-01 00:00:00"), "customer_id")
    assert out[1]["total_orders"] == 2 and out[1]["lifetime_value_vnd"] == 3_000_000
    assert out[1]["first_order_date"] == dt.datetime(2025, 1, 1)
    assert out[3]["customer_segment"] == "New" and out[3]["total_orders"] == 0


def test_single_object_file_is_one_record(spark, gold):
    assert js.read_source(spark, gold.root, "locations").count() == 1
