"""Scalar helpers P1-P35 on literal frames (FIXTURES part A + edge rows)."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from martwise.functions import columns as C


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["First Name", "last-name", "AGE"])
    assert C.standardize_columns(df).columns == ["first_name", "last_name", "age"]


def test_parse_datetime_forms(spark):
    cases = {
        "2025-01-15T10:30:00Z": dt.datetime(2025, 1, 15, 10, 30),
        "2025-06-20T15:00:00+07:00": dt.datetime(2025, 6, 20, 8, 0),
        "2025-03-15": dt.datetime(2025, 3, 15),
        "2025-03-15 10:00:00.250": dt.datetime(2025, 3, 15, 10, 0, 0, 250000),
        "not a date": None,
        None: None,
    }
    for text, want in cases.items():
        assert one(spark, C.parse_utc_timestamp, text) == want, text


def test_mixed_formats_parse_per_value(spark):
    # Q10: the format of one value does not decide the others
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-02T03:04:05.5Z",)], "v string")
    got = [r[0] for r in df.select(C.parse_utc_timestamp("v")).collect()]
    assert got == [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2, 3, 4, 5, 500000)]


def test_date_key(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 15),), (dt.datetime(2025, 12, 1),), (None,)], "d timestamp_ntz")
    assert [r[0] for r in df.select(C.date_key("d")).collect()] == [20250315, 20251201, 0]


def test_surrogate_key_matches_md5_prefix(spark):
    df = spark.createDataFrame([("order_1", "shopify"), ("order_2", "shopify")], "a string, b string")
    keys = [r[0] for r in df.select(C.surrogate_key("a", "b")).collect()]
    assert keys[0] == hashlib.md5(b"order_1|shopify").hexdigest()[:16]
    assert len(keys[0]) == 16 and keys[0] != keys[1]


def test_surrogate_key_nulls_and_numbers(spark):
    df = spark.createDataFrame([(None, 10), ("a", None)], "a string, b bigint")
    keys = [r[0] for r in df.select(C.surrogate_key("a", "b")).collect()]
    assert keys[0] == hashlib.md5(b"None|10").hexdigest()[:16]  # Q11: no '10.0'
    assert keys[1] == hashlib.md5(b"a|None").hexdigest()[:16]


def test_to_long_or_zero(spark):
    for text, want in {"12": 12, "1.9": 1, "-2.7": -2, "x": 0, None: 0, "12345678901234567": 12345678901234567,
                       "23.0": 23}.items():
        assert one(spark, C.to_long_or_zero, text) == want, text


def test_to_double_and_nullable_long(spark):
    assert one(spark, C.to_double_or_zero, "1.5") == 1.5
    assert one(spark, C.to_double_or_zero, "x") == 0.0
    assert one(spark, C.to_nullable_long, "7") == 7
    assert one(spark, C.to_nullable_long, "1.5") is None  # P11: fractional id is no id


def test_gateway_status_codes(spark):
    df = spark.createDataFrame([("0",), ("1006",), (None,), ("1",)], "c string")
    momo = [r[0] for r in df.select(C.code_status("c", 0)).collect()]
    zalo = [r[0] for r in df.select(C.code_status("c", 1)).collect()]
    assert momo == ["success", "failed", "failed", "failed"]
    assert zalo == ["failed", "failed", "failed", "success"]


def test_zalopay_method(spark):
    df = spark.createDataFrame([("36",), (None,)], "c string")
    assert [r[0] for r in df.select(C.zalopay_method("c")).collect()] == ["zalopay_ch36", "zalopay_ch"]


def test_line_total(spark):
    df = spark.createDataFrame([(0, 100, 2), (500, 100, 2), (0, 0, 2), (0, 100, 0)], "t long, p long, q long")
    assert [r[0] for r in df.select(C.line_total("t", "p", "q")).collect()] == [200, 500, 0, 0]


def test_usd_to_vnd(spark):
    df = spark.createDataFrame([(0, -1.5), (0, 0.0), (5, 2.0), (0, 0.00001)], "v long, u double")
    assert [r[0] for r in df.select(C.usd_to_vnd_fill("v", "u")).collect()] == [-37500, 0, 5, 0]
    df2 = spark.createDataFrame([(0.0625,), (-0.0625,)], "u double")
    # the views round half away from zero: 1562.5 -> 1563 (the load truncates)
    assert [r[0] for r in df2.select(C.usd_to_vnd_rounded("u")).collect()] == [1563, -1563]


def test_whole_days_not_date_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(C.whole_days("a", "b"), F.datediff(F.col("b"), F.col("a")), C.whole_hours("a", "b")).first()
    assert (r[0], r[1], r[2]) == (0, 1, 2)
    neg = spark.createDataFrame([(dt.datetime(2024, 1, 5, 10), dt.datetime(2001, 7, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert neg.select(C.whole_days("a", "b")).first()[0] == -8223  # toward zero


def test_recency_null_is_9999(spark):
    df = spark.createDataFrame([(None,)], "d timestamp_ntz")
    assert df.select(C.recency_days("d", C.as_of_literal("2025-01-01"))).first()[0] == 9999


def test_holidays(spark):
    df = spark.createDataFrame([(dt.date(2025, 4, 30),), (dt.date(2025, 4, 29),), (dt.date(2025, 9, 2),)], "d date")
    assert [r[0] for r in df.select(C.is_holiday("d")).collect()] == [True, False, True]


def test_integers_of_text_with_a_point_skip_the_integer_cast(spark):
    # a cast that fails raises and catches an exception for its row: text with a point must not meet it
    texts = ["23.0", " 23.9 ", "-0.9", ".5", "5.", "1.0E7", "1e3", "7", " -7 ", "9223372036854775807", "9223372036854775807.0",
             "1.0E30", "9223372036854775808", "abc", "a.b", ".", "", "1.5d", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    plain = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    got = df.select(C.truncated_long("t").alias("new"), plain.alias("old"), C.to_long_or_zero("t").alias("zero")).collect()
    assert [r["new"] for r in got] == [r["old"] for r in got]
    assert [r["zero"] for r in got] == [r["old"] or 0 for r in got]
    assert got[0]["new"] == 23 and got[9]["new"] == 9223372036854775807
    plan = df.filter(C.to_long_or_zero("t") > 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan and plan.index("Contains(") < plan.index("try_cast(t")
