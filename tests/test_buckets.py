"""Tables co-located on the customer: V1 and B12 without a shuffle of them, hot customers apart."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from martwise.operators import rfm
from martwise.plans import colocated, views
from martwise.plans.gold import EVENTS_AS_OF, ORDERS_AS_OF, DriverGold, RawJsonGold
from martwise.plans.jobs import publish_gold, published
from martwise.sinks import buckets, versions
from martwise.sinks import tables as sinks
from tests import fixtures
from tests.conftest import SF001


@pytest.fixture()
def database(spark, tmp_dir):
    name = f"db_{uuid.uuid4().hex[:8]}"
    sinks.create_database_if_not_exists(spark, name, f"{tmp_dir}/{name}")
    return name


@pytest.fixture()
def no_broadcast(spark):
    """Joins of large tables: none is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan(df)))


def hot_gold(spark):
    """The driver tables with a third of the events and of the orders on one customer each, and some on none."""
    g = DriverGold(spark, SF001)
    def pile(df, column, one):
        h = F.pmod(F.xxhash64(column), F.lit(12))
        return df.withColumn("customer_id", F.when(h < 4, F.lit(one).cast("long")).when(h > 4, F.col("customer_id")))
    customers = g.dim_customers.unionByName(g.dim_customers.limit(3).withColumn("customer_id", F.lit(None).cast("long")))
    return {"fact_cart_events": pile(g.fact_cart_events, "event_key", 7), "fact_orders": pile(g.fact_orders, "order_key", 11),
            "dim_customers": customers}


def test_views_over_buckets_equal_plain_ones(spark, database, no_broadcast):
    plain = hot_gold(spark)
    t = colocated.colocate_gold(plain, database, 4, hot_rows=50)
    events, customers, orders = t["fact_cart_events"], t["dim_customers"], t["fact_orders"]
    assert [r[0] for r in events.hot_keys.collect()] == [7] and [r[0] for r in orders.hot_keys.collect()] == [11]
    assert customers.hot_keys.isEmpty() and customers.hot.count() == 3
    assert events.rows.filter("customer_id = 7 OR customer_id IS NULL").isEmpty()
    assert rows(events.whole()) == rows(plain["fact_cart_events"])
    assert rows(colocated.customer_journey(events, customers, orders)) == rows(
        views.customer_journey(plain["fact_cart_events"], plain["dim_customers"], plain["fact_orders"]))
    for as_of in (ORDERS_AS_OF, EVENTS_AS_OF):
        assert rows(colocated.update_customer_aggregates(customers, orders, as_of)) == rows(
            rfm.update_customer_aggregates(plain["dim_customers"], plain["fact_orders"], as_of))


def test_no_table_in_buckets_is_shuffled(spark, database, no_broadcast):
    t = colocated.colocate_gold(hot_gold(spark), database, 4, hot_rows=50)
    events, customers, orders = t["fact_cart_events"], t["dim_customers"], t["fact_orders"]
    journey = colocated._journey_in_buckets(events, customers, orders)
    # the one shuffle is of the hot customers' order totals, combined before it
    assert plan(journey).count("Bucketed: true") == 3 and shuffles(journey) == 1
    assert shuffles(views.journey_purchases(orders.hot)) == 1 and shuffles(views.journey_purchases(orders.rows)) == 0
    known = colocated._customers_in_buckets(customers, orders)
    assert plan(known).count("Bucketed: true") == 2 and shuffles(known) == 1
    plain = views.customer_journey(events.whole(), customers.whole(), orders.whole())
    assert shuffles(plain) > 5  # what the same view shuffles otherwise


def test_a_hot_customer_is_read_by_many_tasks(spark, database):
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(5)).alias("k"), F.col("id").alias("v"))
    df = df.repartition(6)
    t = f"{database}.t"
    assert buckets.publish_colocated(df, t, "k", 4, ("v",), hot_rows=1000) == n
    c = buckets.open_colocated(spark, t)
    assert (c.key, c.buckets) == ("k", 4) and [r[0] for r in c.hot_keys.collect()] == [5]
    assert c.hot.count() == n // 3 + 1 and len(c.hot.inputFiles()) > 1  # k = 5 has a row of its own too
    per_bucket = [r[0] for r in c.rows.groupBy(F.pmod(F.hash("k"), F.lit(4))).count().select("count").collect()]
    assert len(per_bucket) == 4 and max(per_bucket) < 1.2 * sum(per_bucket) / 4
    assert len(c.rows.inputFiles()) <= 4  # whole buckets are written, not a piece a task


def test_versions_of_a_colocated_table(spark, database):
    t = f"{database}.t"
    frame = lambda k: spark.range(40).select((F.col("id") % k).alias("k"), "id")
    assert buckets.publish_colocated(frame(40), t, "k", 4, hot_rows=5) == 40
    assert buckets.open_colocated(spark, t).hot_keys.isEmpty()
    first = versions.table_location(spark, t)
    lost = frame(40).withColumn("id", F.when(F.col("id") >= 0, F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        buckets.publish_colocated(lost, t, "k", 4, hot_rows=5)
    assert versions.table_location(spark, t) == first and buckets.open_colocated(spark, t).whole().count() == 40
    assert buckets.publish_colocated(frame(3), t, "k", 4, hot_rows=5) == 40  # all keys are hot
    c = buckets.open_colocated(spark, t)
    assert c.rows.isEmpty() and c.hot_keys.count() == 3 and rows(c.whole()) == rows(frame(3))
    assert buckets.publish_colocated(frame(3).limit(0), t, "k", 4) == 0 and buckets.open_colocated(spark, t).whole().count() == 40
    assert buckets.publish_colocated(frame(20), t, "k", 8, hot_rows=5) == 40  # another layout
    c = buckets.open_colocated(spark.newSession(), t)
    assert c.buckets == 8 and rows(c.whole()) == rows(frame(20))
    assert [x.name for x in spark.catalog.listTables(database)] == ["t"]
    gone = buckets.drop_old_colocated(spark, t, keep=0)
    assert gone and rows(buckets.open_colocated(spark, t).whole()) == rows(frame(20))
    assert not any(sinks.path_exists(spark, buckets._hot_folder(spark, t, v)) for v in gone)


def test_empty_tables_and_dimensions_with_repeats(spark, database):
    g = DriverGold(spark, SF001)
    empty = {n: getattr(g, n).limit(0) for n in colocated.SORTED}
    t = colocated.colocate_gold(empty, database, 4)
    assert colocated.customer_journey(t["fact_cart_events"], t["dim_customers"], t["fact_orders"]).isEmpty()
    assert colocated.update_customer_aggregates(t["dim_customers"], t["fact_orders"], ORDERS_AS_OF).isEmpty()
    twice = g.dim_customers.withColumn("customer_id", F.lit(1).cast("long"))
    t["dim_customers"] = colocated.colocate_gold({"dim_customers": twice}, database, 2, hot_rows=5, prefix="r_")["dim_customers"]
    with pytest.raises(ValueError, match="customer"):
        colocated.update_customer_aggregates(t["dim_customers"], t["fact_orders"], ORDERS_AS_OF)
    sinks.save_as_table(spark.range(3), f"{database}.plain")
    with pytest.raises(ValueError, match="not co-located"):
        buckets.open_colocated(spark, f"{database}.plain")


def test_a_run_publishes_tables_by_customer(spark, tmp_dir):
    gold = RawJsonGold(spark, fixtures.write_exports(f"{tmp_dir}/exports"))
    as_of = "2025-04-01 00:00:00"
    plain, dealt = (f"shop_{uuid.uuid4().hex[:8]}" for _ in range(2))
    assert publish_gold(gold, plain, f"{tmp_dir}/{plain}", as_of) == publish_gold(gold, dealt, f"{tmp_dir}/{dealt}", as_of, buckets=3)
    assert rows(published(spark, plain, "dim_customers")) == rows(published(spark, dealt, "dim_customers"))
    t = colocated.open_gold(spark, dealt)
    assert {n: c.buckets for n, c in t.items()} == dict.fromkeys(colocated.SORTED, 3)
    assert rows(t["dim_customers"].whole()) == rows(published(spark, dealt, "dim_customers"))
    journey = colocated.customer_journey(t["fact_cart_events"], t["dim_customers"], t["fact_orders"])
    assert rows(journey) == rows(spark.table(f"{plain}.vw_customer_journey"))
