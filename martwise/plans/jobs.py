"""Run modes R1-R4 as Spark jobs.

The source ran phases one after another in one process.  Here each gold
table is one lazy plan with one action, its write; aggregates and views
are then computed from the written tables, so every later step reads
pruned Parquet and never recomputes the raw parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise import schemas
from martwise.operators import quality, rfm
from martwise.plans import checks, colocated, view_sql, views
from martwise.plans.gold import GOLD_NAMES, GoldBase
from martwise.schemas import LAYOUT
from martwise.sinks import tables as sinks
from martwise.sinks import versions
from martwise.sources import json_sources as js


def _path(out_root: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/{name}"


def write_gold(gold: GoldBase, out_root: str, names=GOLD_NAMES, as_of=None, observed: dict | None = None) -> dict[str, int]:
    """Phases A-E: each gold table written with its day partition and
    clustering (K1); returns rows written per table.  ``observed`` gets the
    checks that each write has taken of its table."""
    counts = {}
    for name in names:
        field, cluster = LAYOUT.get(name, (None, ()))
        raw = gold.raw_for(name)
        if raw is None:  # the source is absent: nothing to write, old table kept (K2)
            counts[name] = 0
            continue
        df, found = getattr(gold, name), {}
        counts[name] = sinks.write_table(df, _path(out_root, name), "WRITE_TRUNCATE", field, cluster, empty_probe=raw,
                                         metrics=checks.observed(name, df.columns, as_of), found=found)
        if observed is not None and found:
            observed[name] = found
    return counts


def read_gold(spark: SparkSession, out_root: str, names=GOLD_NAMES) -> dict[str, DataFrame]:
    """The written tables; one that was never written reads as empty."""
    out = {}
    for name in names:
        path = _path(out_root, name)
        sinks.recover_table(spark, path)
        if not sinks.path_exists(spark, path):  # its source was empty on every run so far
            out[name] = spark.createDataFrame([], schemas.GOLD[name])
            continue
        df = spark.read.parquet(path)
        field = LAYOUT.get(name, (None, ()))[0]
        out[name] = df.drop(sinks.day_column(field)) if field else df
    return out


def gold_views(t: dict[str, DataFrame], as_of=None) -> dict[str, callable]:
    return {
        "vw_customer_journey": lambda: views.customer_journey(t["fact_cart_events"], t["dim_customers"],
                                                              t["fact_orders"]),
        "vw_cashflow_daily": lambda: views.cashflow_daily(t["fact_orders"], t["fact_payments"],
                                                          t["fact_bank_transactions"]),
        "vw_payment_status": lambda: views.payment_status(t["fact_orders"], t["dim_customers"],
                                                          t["fact_payments"], as_of=as_of),
    }


def quality_checks(t: dict[str, DataFrame], as_of=None, observed: dict | None = None) -> DataFrame:
    """DQ1-DQ4 of every gold table, as the DQ5 long report.  Tables in
    ``observed`` bring their null, date and blank-id counts from their write;
    the others are read for them."""
    observed = observed or {}
    read = {n: df for n, df in t.items() if n not in observed}
    profiles = [quality.table_profile(df, n, checks.NULL_COLUMNS.get(n, ()), checks.DATE_COLUMNS.get(n), as_of,
                                      blank_id_column=checks.BLANK_IDS.get(n))
                for n, df in read.items() if n in checks.NULL_COLUMNS]
    if observed:
        profiles.append(checks.observed_report(next(iter(t.values())).sparkSession, observed))
    dups = [quality.duplicate_counts(t[n], [k], n) for n, k in checks.DUPLICATE_KEYS.items()]
    amounts = [quality.amount_stats_many([(t[n], cols, n, neg) for n, (cols, neg) in checks.AMOUNTS.items()])]
    return quality.quality_report(dups=dups, amounts=amounts, profiles=profiles)


# Tables with a row for every raw record but for removed duplicates.
ROW_PER_RECORD = ("fact_orders", "fact_payments", "fact_cart_events", "fact_bank_transactions", "dim_customers",
                  "dim_products", "dim_locations")


def duplicates_removed(gold: GoldBase, counts: dict[str, int]) -> DataFrame:
    """DQ2 / A9 as the source took it, before the removal: raw records less
    the rows written, per table, as rows of the summary.  Reads the raw
    sources once more, for their counts alone."""
    spark = gold.spark
    out = spark.createDataFrame([], "table_name string, check_name string, column_name string, value double")
    for name in ROW_PER_RECORD:
        raw = gold.raw_for(name)
        if raw is None:
            continue
        removed = (F.count(F.lit(1)) - F.lit(counts.get(name, 0))).cast("double")
        out = out.unionByName(raw.agg(removed.alias("value")).select(
            F.lit(name).alias("table_name"), F.lit("duplicates_removed").alias("check_name"),
            F.lit(None).cast("string").alias("column_name"), "value"))
    return out


def run_summary(spark: SparkSession, counts: dict[str, int], report: DataFrame | None = None) -> DataFrame:
    """Rows per table, plus the quality report, as one table
    (table_name, check_name, column_name, value)."""
    rows = spark.createDataFrame([(k, "rows", None, float(v)) for k, v in counts.items()],
                                 "table_name string, check_name string, column_name string, value double")
    return rows if report is None else rows.unionByName(report)


def run_full_pipeline(gold: GoldBase, out_root: str, as_of=None) -> DataFrame:
    """Write every gold table, refresh dim_customers with order
    aggregates and RFM segments (staged replace, K8), register the three
    views (K6), and return the run summary (R4) with the quality report and
    the duplicates that the builders removed."""
    spark = gold.spark
    observed: dict = {}
    counts = write_gold(gold, out_root, as_of=as_of, observed=observed)
    removed = duplicates_removed(gold, counts)
    t = read_gold(spark, out_root)
    if counts.get("fact_orders", 0) > 0:
        updated = rfm.update_customer_aggregates(t["dim_customers"], t["fact_orders"], as_of=as_of)
        field, cluster = LAYOUT["dim_customers"]
        found: dict = {}
        counts["dim_customers"] = sinks.replace_table(
            updated, _path(out_root, "dim_customers"), field, cluster, empty_probe=t["dim_customers"],
            metrics=checks.observed("dim_customers", updated.columns, as_of), found=found)
        observed.update({"dim_customers": found} if found else {})
        t = read_gold(spark, out_root)
    sinks.create_views(gold_views(t, as_of))
    return run_summary(spark, counts, quality_checks(t, as_of, observed).unionByName(removed))


def published(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A table of ``publish_gold`` with the columns of its schema."""
    field = LAYOUT.get(name, (None, ()))[0]
    df = spark.table(f"{database}.{name}")
    return df.drop(sinks.day_column(field)) if field else df


def publish_gold(gold: GoldBase, database: str, location: str | None = None, as_of=None,
                 buckets: int | None = None) -> dict[str, int]:
    """R1 into the catalog: every gold table is published as a version of
    ``database``'s table of that name (K1), dim_customers then once more with its
    aggregates (K8), and the three views are stored beside them (K6).  At no
    time does a reader find a table missing or half written.  Returns the rows
    per table; a table whose source is empty is left as it was, or made empty.
    ``buckets``: the tables that the customer joins are also dealt out by
    customer (``colocated.open_gold`` reads them), and the aggregates are taken there."""
    spark = gold.spark
    sinks.create_database_if_not_exists(spark, database, location)
    counts = {}
    for name in GOLD_NAMES:
        field, cluster = LAYOUT.get(name, (None, ()))
        table = f"{database}.{name}"
        raw = gold.raw_for(name)
        counts[name] = 0 if raw is None else versions.publish_table(getattr(gold, name), table, field, cluster, raw)
        if not spark.catalog.tableExists(versions.quoted(spark, table)):
            spark.createDataFrame([], schemas.GOLD[name]).write.saveAsTable(versions.quoted(spark, table))
    by_customer = {}
    if buckets:
        by_customer = colocated.colocate_gold({n: published(spark, database, n) for n in colocated.SORTED}, database, buckets)
    if counts["fact_orders"]:
        field, cluster = LAYOUT["dim_customers"]
        customers = published(spark, database, "dim_customers")
        if buckets:
            updated = colocated.update_customer_aggregates(by_customer["dim_customers"], by_customer["fact_orders"], as_of)
        else:
            updated = rfm.update_customer_aggregates(customers, published(spark, database, "fact_orders"), as_of=as_of)
        counts["dim_customers"] = versions.publish_table(updated, f"{database}.dim_customers", field, cluster, customers)
        if buckets:
            colocated.colocate_gold({"dim_customers": published(spark, database, "dim_customers")}, database, buckets)
    view_sql.store_views(spark, database, as_of)
    return counts


def run_extract_only(spark: SparkSession, root: str) -> DataFrame:
    """R2: records per raw source (one count job over a union of sources)."""
    parts = []
    for name in js.SOURCE_FILES:
        df = js.read_source_if_present(spark, root, name)  # absent: skipped; partial: error
        if df is None:
            continue
        parts.append(df.select(F.lit(name).alias("source")))
    if not parts:
        return spark.createDataFrame([], "source string, records bigint")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("records"))


def run_transform_only(gold: GoldBase) -> DataFrame:
    """Every gold table is built and its rows are counted; no RFM, no write."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in gold.all_tables().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return gold.spark.createDataFrame(out.collect(), out.schema)  # one row a table
