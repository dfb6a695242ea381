"""Dimension builders B1-B5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise import schemas
from martwise.functions.columns import (
    conform, date_key, is_holiday, parse_utc_timestamp, rename_existing, standardize_columns,
    to_nullable_long, truncated_long,
)
from martwise.operators.dedup import keep_first_with_id
from martwise.sources.json_sources import SEQ, calendar, conform_raw

NEW_SEGMENT = "New"
DEFAULT_CALENDAR = ("2024-01-01", "2027-12-31")


def _raw(df: DataFrame, schema, renames: dict[str, str] | None = None) -> DataFrame:
    """P1 + P2 + P3: normalised names, raw fields (missing as null), seq kept."""
    df = standardize_columns(df)
    if renames:
        df = rename_existing(df, renames)
    out = conform_raw(df, schema)
    if SEQ not in out.columns:
        out = out.withColumn(SEQ, F.lit(None).cast("struct<file:string,pos:bigint>"))
    return out


def _one_per_id(df: DataFrame, key: str, raw_id: str, schema) -> DataFrame:
    """D1 by the parsed id; ids that do not parse are told apart by their
    text, and rows without an id are all kept (Q22)."""
    text = F.trim(F.col(raw_id))
    staged = df.withColumn("_unparsed", F.when(F.col(key).isNull(), text))
    return conform(keep_first_with_id(staged, [key, "_unparsed"], raw_id, [SEQ], schema.fieldNames()), schema)


def dim_customers(raw_customers: DataFrame) -> DataFrame:
    """B1: customers with the aggregate columns at their initial values."""
    r = _raw(raw_customers, schemas.RAW_CUSTOMER)
    df = r.select(
        F.col("id").alias("_id"), to_nullable_long("id").alias("customer_id"), "email", F.col("name").alias("full_name"),
        "phone", "city", "country", parse_utc_timestamp("created_at").alias("created_at"),
        F.lit(NEW_SEGMENT).alias("customer_segment"), F.lit(0).cast("bigint").alias("lifetime_value_vnd"),
        F.lit(0).cast("bigint").alias("total_orders"), F.lit(None).cast("timestamp_ntz").alias("first_order_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_order_date"), F.col(SEQ))
    return _one_per_id(df, "customer_id", "_id", schemas.DIM_CUSTOMERS)


def dim_products(raw_products: DataFrame) -> DataFrame:
    """B2."""
    r = _raw(raw_products, schemas.RAW_PRODUCT)
    df = r.select(
        F.col("id").alias("_id"), to_nullable_long("id").alias("product_id"), F.col("name").alias("product_name"), "sku", "barcode",
        "category", "brand", truncated_long("price_vnd").alias("price_vnd"),
        F.col("price_usd").try_cast("double").alias("price_usd"),
        truncated_long("stock_quantity").alias("stock_quantity"),
        F.lit(True).alias("is_active"), F.col(SEQ))
    return _one_per_id(df, "product_id", "_id", schemas.DIM_PRODUCTS)


def dim_locations(raw_locations: DataFrame) -> DataFrame:
    """Every location is a store."""
    r = _raw(raw_locations, schemas.RAW_LOCATION)
    df = r.select(
        F.col("id").alias("_id"), to_nullable_long("id").alias("location_id"), F.col("code").alias("location_code"),
        F.col("name").alias("location_name"), F.lit("store").alias("location_type"), "city", "address",
        "phone", F.lit(True).alias("is_active"), F.col(SEQ))
    return _one_per_id(df, "location_id", "_id", schemas.DIM_LOCATIONS)


def dim_staff(raw_pos_orders: DataFrame | None) -> DataFrame | None:
    """Staff seen on POS orders; ``staff`` else ``staff_member``; only a
    truthy id (FL4); the first order naming a staff member wins (D2).
    Returns None when there are no orders (callers write an empty table)."""
    if raw_pos_orders is None:
        return None
    r = _raw(raw_pos_orders, schemas.RAW_ORDER)
    person = F.when(F.col("staff.id").isNotNull(), F.col("staff")).otherwise(F.col("staff_member"))
    df = r.select(person.alias("p"), F.col("location_id"), F.col(SEQ)) \
          .filter(F.col("p.id").isNotNull() & ~F.trim(F.col("p.id")).isin("", "0"))
    df = df.select(
        F.col("p.id").alias("_id"), to_nullable_long("p.id").alias("staff_id"),
        F.coalesce(F.col("p.code"), F.lit("")).alias("staff_code"),
        F.coalesce(F.col("p.name"), F.lit("")).alias("full_name"),
        F.coalesce(F.col("p.position"), F.lit("Staff")).alias("position"),
        F.coalesce(F.col("p.email"), F.lit("")).alias("email"),
        F.coalesce(F.col("p.phone"), F.lit("")).alias("phone"),
        to_nullable_long("location_id").alias("location_id"),
        F.lit(None).cast("timestamp_ntz").alias("hire_date"), F.lit(True).alias("is_active"), F.col(SEQ))
    return _one_per_id(df, "staff_id", "_id", schemas.DIM_STAFF)


def date_attributes(days: DataFrame, date_col: str = "full_date") -> DataFrame:
    """P23 + P24: calendar attributes of a column of dates."""
    d = F.col(date_col)
    dow = F.weekday(d)  # 0 = Monday
    return days.select(
        date_key(d).alias("date_key"), d.alias("full_date"), F.year(d).alias("year"),
        F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), (dow >= 5).alias("is_weekend"),
        is_holiday(d).alias("is_holiday"), F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"))


def dim_date(spark: SparkSession, start=DEFAULT_CALENDAR[0], end=DEFAULT_CALENDAR[1]) -> DataFrame:
    """One row per day between two dates."""
    return conform(date_attributes(calendar(spark, start, end)), schemas.DIM_DATE)


def dim_date_spanning(df: DataFrame, ts_col: str) -> DataFrame:
    """B5 over the days a fact covers: the bounds are one aggregate row; the
    calendar it expands to is bounded by the date span, not the row count."""
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("_lo"), F.max(F.to_date(ts_col)).alias("_hi"))
    days = bounds.filter(F.col("_lo").isNotNull()) \
                 .select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return conform(date_attributes(days), schemas.DIM_DATE)
