"""Scalar Column helpers (survey rows P1-P35).

All are built-in expressions, so they stay inside whole-stage codegen; no
Python runs per row.  Each takes and returns Columns (or column names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the source system's.
USD_TO_VND_RATE = 25000
HOLIDAYS_MM_DD = ["01-01", "04-30", "05-01", "09-02"]
NULL_KEY_TEXT = "None"  # text a null part takes inside a surrogate key
NO_ORDER_RECENCY_DAYS = 9999
OVERDUE_AFTER_DAYS = 30


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1
def standardize_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Lower case; space and '-' become '_'."""
    return df.toDF(*[standardize_name(c) for c in df.columns])


# P2 / P3
def rename_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def conform(df: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """P3 + P4: add missing columns as typed nulls, cast, and order as
    ``schema``; ``extra`` helper columns (sequence, priority) ride along."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ], *extra)


# P6
def parse_utc_timestamp(c) -> Column:
    """Text (offset, 'Z', naive or date-only) to a UTC wall-clock
    timestamp_ntz; text that does not parse becomes null.  Relies on the
    session zone being UTC (see session.CORE_CONF)."""
    c = col(c)
    return F.try_to_timestamp(F.trim(c.cast("string"))).cast("timestamp_ntz")


# P7
def date_key(c) -> Column:
    """YYYYMMDD as int; a null date gives 0."""
    return F.coalesce(F.date_format(col(c), "yyyyMMdd").cast("int"), F.lit(0))


def integral_text(c) -> Column:
    """Text of a value, with the '.0' of an integral number taken off."""
    text = col(c).cast("string")
    return F.when(text.endswith("0") & text.contains("."), F.regexp_replace(text, r"^([+-]?\d+)\.0+$", "$1")).otherwise(text)


# P8 / Q11
def key_part(c) -> Column:
    """Text of one key part: integral numbers without '.0', null as 'None'."""
    return F.coalesce(integral_text(c), F.lit(NULL_KEY_TEXT))


def surrogate_key(*parts) -> Column:
    """First 16 hex digits of MD5 over the parts joined by '|'.

    ``concat_ws`` drops nulls, so each part is made non-null first; that
    keeps ('a', null) and (null, 'a') apart.
    """
    return F.left(F.md5(F.concat_ws("|", *[key_part(p) for p in parts])), F.lit(16))


# P9 / P10 / P11 / P12
def truncated_long(c) -> Column:
    """Integer of a text, truncating toward zero; bad or null is null.
    Integral text is read exactly; only fractional text goes through double.
    Text with a point is no integer: casting it to one first would raise and
    catch an exception for every row, many times the cost of the cast."""
    c = col(c).cast("string")
    through_double = c.try_cast("double").try_cast("bigint")
    return F.when(c.contains("."), through_double).otherwise(F.coalesce(c.try_cast("bigint"), through_double))


def to_long_or_zero(c) -> Column:
    """Coerce to integer, truncating toward zero; bad or null is 0."""
    return F.coalesce(truncated_long(c), F.lit(0).cast("bigint"))


def to_double_or_zero(c) -> Column:
    """P10: coerce to double; bad or null is 0.0."""
    return F.coalesce(col(c).cast("string").try_cast("double"), F.lit(0.0))


def to_nullable_long(c) -> Column:
    """Nullable integer id; integral text may end in '.0'; other text becomes null."""
    return integral_text(c).try_cast("bigint")


def blank_to_null(c) -> Column:
    """Q12/Q22: empty or all-space text is no id."""
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def has_real_id(c) -> Column:
    return blank_to_null(col(c)).isNotNull()


# P19 / P20
def code_status(code, success_code: int) -> Column:
    """Gateway result code to success/failed; missing counts as -1."""
    return F.when(F.coalesce(col(code).cast("string").try_cast("int"), F.lit(-1)) == success_code,
                  F.lit("success")).otherwise(F.lit("failed"))


def zalopay_method(channel) -> Column:
    """P20: 'zalopay_ch{channel}'."""
    return F.concat(F.lit("zalopay_ch"), F.coalesce(col(channel).cast("string"), F.lit("")))


# P21
def line_total(total, price, qty) -> Column:
    """Use the stated line total unless it is 0; then price x quantity
    when both are non-zero (both already integers)."""
    total, price, qty = col(total), col(price), col(qty)
    return (F.when((total == 0) & (price != 0) & (qty != 0), price * qty)
            .otherwise(total))


# P22 / Q8
def usd_to_vnd_fill(vnd, usd) -> Column:
    """VND from USD at the fixed rate when VND is 0 and USD is not;
    sign kept, truncated toward zero."""
    vnd, usd = col(vnd), col(usd)
    return (F.when((vnd == 0) & (usd != 0), (usd * F.lit(USD_TO_VND_RATE)).try_cast("bigint"))
            .otherwise(vnd))


def usd_to_vnd_rounded(usd) -> Column:
    """The views' CAST(x AS INT64) rounds (half away from zero)."""
    return F.round(col(usd) * F.lit(USD_TO_VND_RATE)).try_cast("bigint")


# P25 / P27
def whole_days(start, end) -> Column:
    """Whole days from start to end, toward zero (not date boundaries)."""
    return F.timestamp_diff("DAY", col(start), col(end))


def whole_hours(start, end) -> Column:
    return F.timestamp_diff("HOUR", col(start), col(end))


def recency_days(last_order_date, as_of) -> Column:
    """P25: days since the last order; no order gives 9999."""
    return F.coalesce(whole_days(last_order_date, as_of), F.lit(NO_ORDER_RECENCY_DAYS).cast("bigint"))


# P23 / P24
def is_holiday(d) -> Column:
    return F.date_format(col(d), "MM-dd").isin(*HOLIDAYS_MM_DD)


def count_if(cond: Column) -> Column:
    """Rows where cond is true (null counts as false); 0 on empty input."""
    return F.count_if(cond)


def as_of_literal(as_of) -> Column:
    """The 'now' of a run is an argument; None means the current time."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")
