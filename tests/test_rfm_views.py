"""P26 segment matrix (all 25 cells), RFM scoring, and views V1-V3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martwise.operators import rfm
from martwise.plans import views

# R x F matrix as coded by the source system (rows R 5..1, columns F 5..1).
MATRIX = {
    5: ["Champions", "Champions", "Potential Loyalist", "Promising", "New Customer"],
    4: ["Champions", "Champions", "Potential Loyalist", "Promising", "New Customer"],
    3: ["Loyal", "Loyal", "Need Attention", "About To Sleep", "About To Sleep"],
    2: ["At Risk", "At Risk", "Lost", "About To Sleep", "Hibernating"],
    1: ["Cannot Lose Them", "Cannot Lose Them", "Hibernating", "Lost", "Lost"],
}


def test_segment_matrix_all_cells(spark):
    pairs = [(r, f) for r in range(1, 6) for f in range(1, 6)]
    df = spark.createDataFrame(pairs, "r int, f int")
    got = {(x["r"], x["f"]): x["s"] for x in df.select("r", "f", rfm.rfm_segment(F.col("r"), F.col("f")).alias("s")).collect()}
    for r, row in MATRIX.items():
        for i, seg in enumerate(row):
            assert got[(r, 5 - i)] == seg, (r, 5 - i)


@pytest.mark.parametrize("n", [1, 2, 5, 7, 11])
def test_rfm_scores_small_n(spark, n):
    import pandas as pd
    rows = [(i, (i * 7) % 5 + 1, 1000 * ((i * 3) % 4), dt.datetime(2025, 1, 1) + dt.timedelta(days=(i * 11) % 9))
            for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id long, total_orders long, lifetime_value_vnd long, last_order_date timestamp_ntz")
    got = {r["customer_id"]: r for r in rfm.rfm_scores(df, as_of="2025-02-01 00:00:00").collect()}
    pdf = pd.DataFrame(rows, columns=["customer_id", "total_orders", "lifetime_value_vnd", "last"])
    pdf["recency"] = (pd.Timestamp("2025-02-01") - pdf["last"]).dt.days

    def q(s, labels):
        if len(s) == 1:
            return [labels[0] if labels[0] == 1 else 5]
        return list(pd.qcut(s.rank(method="first"), q=5, labels=labels).astype(int))
    r = q(pdf["recency"], [5, 4, 3, 2, 1]) if n > 1 else [5]
    f = q(pdf["total_orders"], [1, 2, 3, 4, 5]) if n > 1 else [1]
    for i, cid in enumerate(pdf["customer_id"]):
        assert (got[cid]["r_score"], got[cid]["f_score"]) == (r[i], f[i]), cid


def test_cashflow_daily_rules(spark):
    orders = spark.createDataFrame([
        (dt.datetime(2025, 1, 1, 10), "completed", 100), (dt.datetime(2025, 1, 1, 12), None, 50),
        (dt.datetime(2025, 1, 1, 13), "cancelled", 70), (None, "completed", 5)],
        "order_date timestamp_ntz, status string, total_vnd long")
    pays = spark.createDataFrame([
        (dt.datetime(2025, 1, 1), "success", 80), (dt.datetime(2025, 1, 2), "failed", 9),
        (dt.datetime(2025, 1, 2), None, 9)], "payment_date timestamp_ntz, payment_status string, amount_vnd long")
    bank = spark.createDataFrame([
        (dt.datetime(2025, 1, 3), "posted", 0, -0.0625), (dt.datetime(2025, 1, 3), "pending", 40, -1.0),
        (dt.datetime(2025, 1, 3), "failed", 99, 1.0)],
        "transaction_date timestamp_ntz, status string, amount_vnd long, amount_usd double")
    got = {r["report_date"]: r for r in views.cashflow_daily(orders, pays, bank).collect()}
    d1 = got[dt.date(2025, 1, 1)]
    assert (d1["sales_revenue_vnd"], d1["order_count"], d1["payments_received_vnd"]) == (100, 1, 80)
    d2 = got[dt.date(2025, 1, 2)]
    assert (d2["successful_payments"], d2["failed_payments"]) == (0, 1)  # null status counts as neither
    d3 = got[dt.date(2025, 1, 3)]
    assert (d3["bank_inflow_vnd"], d3["bank_outflow_vnd"], d3["net_cashflow_vnd"]) == (40, 1563, -1563)
    assert got[None]["sales_revenue_vnd"] == 5  # null dates stay a separate row


def test_payment_status_categories(spark):
    o = spark.createDataFrame([
        ("k1", "1", "T1", 1, dt.datetime(2025, 1, 1), 100), ("k2", "2", "T2", 1, dt.datetime(2025, 1, 1), 100),
        ("k3", "3", "", 2, dt.datetime(2025, 1, 1), 100), ("k4", "4", "T4", 2, dt.datetime(2025, 3, 20), 100),
        ("k5", "5", "T5", None, dt.datetime(2025, 1, 1), 100)],
        "order_key string, order_id string, transaction_id string, customer_id long, order_date timestamp_ntz, total_vnd long")
    for c in ("order_number", "channel", "payment_status", "payment_gateway"):
        o = o.withColumn(c, F.lit(None).cast("string"))
    c = spark.createDataFrame([(1, "An", "a@x"), (2, "Binh", None)], "customer_id long, full_name string, email string")
    p = spark.createDataFrame([
        ("p1", "T1", dt.datetime(2025, 1, 1, 5), "success", 100), ("p2", "T2", dt.datetime(2025, 1, 2), "failed", 0),
        ("p3", "", dt.datetime(2025, 1, 2), "success", 1), ("p5", "T5", dt.datetime(2025, 1, 2), "COMPLETED", 100)],
        "payment_key string, transaction_id string, payment_date timestamp_ntz, payment_status string, amount_vnd long")
    got = {r["order_id"]: r for r in views.payment_status(o, c, p, as_of="2025-04-01 00:00:00").collect()}
    assert got["1"]["payment_status_category"] == "Paid" and got["1"]["payment_delay_hours"] == 5
    assert got["1"]["outstanding_amount_vnd"] == 0 and got["1"]["customer_name"] == "An"
    assert got["2"]["payment_status_category"] == "Failed" and got["2"]["outstanding_amount_vnd"] == 100
    assert got["3"]["payment_status_category"] == "Overdue" and got["3"]["days_overdue"] == 90
    assert got["3"]["payment_key"] is None  # a blank id matches nothing
    assert got["4"]["payment_status_category"] == "Pending" and got["4"]["days_overdue"] == 0
    assert got["5"]["payment_status_category"] == "Unknown"  # raw PayPal status (Q2)


def test_customer_journey(spark):
    ev = spark.createDataFrame([
        ("k1", "e1", "s1", 1, "view_item", dt.datetime(2025, 1, 2, 10)),
        ("k2", "e2", "s1", 1, "add_to_cart", dt.datetime(2025, 1, 2, 9)),
        ("k0", "e3", "s1", 1, "purchase", dt.datetime(2025, 1, 2, 9)),
        ("k3", "e4", "s2", None, "view_item", dt.datetime(2025, 1, 2, 9))],
        "event_key string, event_id string, session_id string, customer_id long, event_type string, event_timestamp timestamp_ntz")
    for col in ("source", "device", "utm_source", "utm_campaign"):
        ev = ev.withColumn(col, F.lit("x"))
    ev = ev.withColumn("product_id", F.lit(1).cast("bigint"))
    cust = spark.createDataFrame([(1, "An", "Champions")], "customer_id long, full_name string, customer_segment string")
    orders = spark.createDataFrame([(1, dt.datetime(2025, 1, 5, 8), 10), (1, dt.datetime(2025, 2, 1), 5)],
                                   "customer_id long, order_date timestamp_ntz, total_vnd long")
    got = {r["session_id"] + str(r["touchpoint_sequence"]): r for r in
           views.customer_journey(ev, cust, orders).collect()}
    assert len(got) == 3  # the event without a customer is not in the journey
    assert got["s11"]["event_type"] == "purchase"  # tie at 09:00 broken by event_key
    assert got["s13"]["event_type"] == "view_item"
    assert got["s11"]["total_purchases"] == 2 and got["s11"]["total_revenue_vnd"] == 15
    assert got["s11"]["days_to_first_purchase"] == 2  # 2025-01-02 09:00 -> 01-05 08:00
