"""K1 / K3 / K8 replaced in one step, K6 views that outlive the session."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from martwise.plans import view_sql, views
from martwise.plans.gold import EVENTS_AS_OF, ORDERS_AS_OF, DriverGold, RawJsonGold
from martwise.plans.jobs import publish_gold, read_gold
from martwise.sinks import tables as sinks
from martwise.sinks import versions
from tests import fixtures
from tests.conftest import SF001


@pytest.fixture()
def database(spark, tmp_dir):
    name = f"db_{uuid.uuid4().hex[:8]}"
    sinks.create_database_if_not_exists(spark, name, f"{tmp_dir}/{name}")
    return name


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def failing(df):
    """Fails in its last rows, when files are already being written."""
    return df.withColumn("id", F.when(F.col("id") >= 4, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))


def test_a_failed_publish_leaves_the_old_version(spark, database):
    t = f"{database}.t"
    assert versions.publish_table(spark.range(5), t) == 5
    old = versions.table_location(spark, t)
    with pytest.raises(Exception, match="lost"):
        versions.publish_table(failing(spark.range(100, numPartitions=4)), t)
    assert versions.table_location(spark, t) == old and ids(spark.table(t)) == [0, 1, 2, 3, 4]
    assert versions.publish_table(spark.range(0), t) == 0 and ids(spark.table(t)) == [0, 1, 2, 3, 4]
    with pytest.raises(Exception, match="lost"):
        versions.publish_table(failing(spark.range(9)), f"{database}.fresh")
    assert not spark.catalog.tableExists(f"{database}.fresh")


def test_a_table_is_replaced_by_what_reads_it(spark, database):
    t = f"{database}.t"
    versions.publish_table(spark.range(3), t)
    before = spark.table(t)  # a reader that listed its files before the swap
    before.count()
    for _ in range(3):
        versions.publish_table(spark.table(t).withColumn("id", F.col("id") * 2), t)
    assert ids(spark.table(t)) == [0, 8, 16] and ids(spark.newSession().table(t)) == [0, 8, 16]
    assert len(versions.table_versions(spark, t)) == 4 and ids(before) == [0, 1, 2]
    assert len(versions.drop_old_versions(spark, t)) == 2 and ids(spark.table(t)) == [0, 8, 16]
    assert len(versions.table_versions(spark, t)) == 2 and versions.drop_old_versions(spark, t, keep=0) != []


def test_modes_and_layout_changes(spark, database):
    t = f"{database}.t"
    day = spark.range(6).select("id", (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int"))).alias("ts"))
    assert sinks.save_as_table(spark.range(2), t) == 2
    assert sinks.save_as_table(day, t, partition_field="ts") == 6  # other columns, partitioned
    assert "ts_day" in spark.table(t).columns and spark.table(t).filter("ts_day = '2025-01-03'").count() == 1
    assert sinks.save_as_table(day.filter("id < 2"), t, "WRITE_APPEND", "ts") == 2 and spark.table(t).count() == 8
    assert versions.publish_table(spark.table(t).filter("id > 3"), t, "ts") == 2 and ids(spark.table(t)) == [4, 5]
    with pytest.raises(ValueError, match="exists"):
        sinks.save_as_table(day, t, "WRITE_EMPTY")
    assert sinks.save_as_table(spark.range(1), t) == 1 and spark.table(t).columns == ["id"]
    assert sinks.save_as_table(spark.range(4), f"{database}.new", "WRITE_EMPTY") == 4


def test_a_failed_replace_leaves_the_path(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(failing(spark.read.parquet(path)), path)
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3, 4]
    os.rename(path, path + "__replaced")  # a job that ended between the two renames
    assert sinks.recover_table(spark, path) and not sinks.recover_table(spark, path)
    assert sinks.replace_table(spark.read.parquet(path).withColumn("id", F.col("id") + 1), path) == 5
    assert ids(spark.read.parquet(path)) == [1, 2, 3, 4, 5] and not os.path.exists(path + "__replaced")


def test_a_failed_rename_puts_the_table_back(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    sinks.write_table(spark.range(5), path)
    rename = sinks.rename_path

    def once(s, old, new):
        if "__staging" in old:
            raise OSError("rename lost")
        rename(s, old, new)
    monkeypatch.setattr(sinks, "rename_path", once)
    with pytest.raises(OSError, match="rename lost"):
        sinks.replace_table(spark.read.parquet(path).limit(2), path)
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3, 4]


def test_gold_tables_set_aside_are_read(spark, tmp_dir):
    sinks.write_table(spark.createDataFrame([(7, "L")], "location_id long, location_name string"), f"{tmp_dir}/dim_locations")
    os.rename(f"{tmp_dir}/dim_locations", f"{tmp_dir}/dim_locations__replaced")
    assert read_gold(spark, tmp_dir, ["dim_locations"])["dim_locations"].count() == 1


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_view_texts_equal_the_dataframe_views(spark):
    g = DriverGold(spark, SF001)
    frames = {t: getattr(g, t) for t in view_sql.TABLES}
    same(view_sql.run_view(spark, "vw_customer_journey", frames),
         views.customer_journey(g.fact_cart_events, g.dim_customers, g.fact_orders))
    same(view_sql.run_view(spark, "vw_cashflow_daily", frames),
         views.cashflow_daily(g.fact_orders, g.fact_payments, g.fact_bank_transactions))
    for as_of in (ORDERS_AS_OF, EVENTS_AS_OF):
        same(view_sql.run_view(spark, "vw_payment_status", frames, as_of),
             views.payment_status(g.fact_orders, g.dim_customers, g.fact_payments, as_of=as_of))


def test_published_gold_serves_stored_views_to_other_sessions(spark, tmp_dir):
    root = fixtures.write_exports(f"{tmp_dir}/exports")
    db = f"shop_{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # the second run replaces every table
        counts = publish_gold(RawJsonGold(spark, root), db, f"{tmp_dir}/{db}", as_of="2025-04-01 00:00:00")
    assert counts["fact_orders"] == 7 and counts["fact_payments"] == 6
    other = spark.newSession()
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}.items():
        other.conf.set(k, v)
    t = {n: spark.table(f"{db}.{n}") for n in view_sql.TABLES}
    same(other.table(f"{db}.vw_customer_journey"), views.customer_journey(t["fact_cart_events"], t["dim_customers"], t["fact_orders"]))
    same(other.table(f"{db}.vw_cashflow_daily"), views.cashflow_daily(t["fact_orders"], t["fact_payments"], t["fact_bank_transactions"]))
    same(other.table(f"{db}.vw_payment_status"), views.payment_status(t["fact_orders"], t["dim_customers"], t["fact_payments"],
                                                                      as_of="2025-04-01 00:00:00"))
    assert {r["customer_id"]: r["total_orders"] for r in other.table(f"{db}.dim_customers").collect()}[1] == 2
    versions.publish_table(spark.table(f"{db}.fact_orders").limit(1), f"{db}.fact_orders", "order_date")
    orders = lambda s: s.table(f"{db}.vw_payment_status").select("order_key").distinct().count()
    assert orders(spark.newSession()) == 1 and orders(other) == 7  # views follow their tables; a session keeps what it resolved
    other.catalog.refreshTable(f"{db}.fact_orders")
    assert orders(other) == 1


def test_a_failing_view_is_skipped(spark, database):
    versions.publish_table(spark.range(1).select(F.lit("x").alias("status")), f"{database}.fact_orders")
    done = view_sql.store_views(spark, database)
    assert done == {"vw_customer_journey": False, "vw_cashflow_daily": False, "vw_payment_status": False}
    for name in view_sql.TABLES:
        g = DriverGold(spark, SF001)
        if name != "fact_cart_events":
            versions.publish_table(getattr(g, name).limit(50), f"{database}.{name}")
    done = view_sql.store_views(spark, database)
    assert done == {"vw_customer_journey": False, "vw_cashflow_daily": True, "vw_payment_status": True}
