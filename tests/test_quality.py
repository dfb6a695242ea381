"""DQ1-DQ5 and keep-first dedup (D1, Q22) on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martwise.operators import quality
from martwise.operators.dedup import keep_first, keep_first_with_id


def test_null_check_counts_and_keeps_rows(spark):
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "C"), (None, "D")], "id int, name string")
    rep = {r["column_name"]: r for r in quality.null_counts(df, ["id", "name", "absent"], "test_table").collect()}
    assert set(rep) == {"id", "name"}
    assert rep["id"]["null_count"] == 1 and rep["name"]["null_count"] == 1
    assert rep["id"]["row_count"] == 4 and rep["id"]["null_pct"] == 25.0
    assert df.count() == 4


def test_duplicates_counted_and_removed(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "id int, value string")
    r = quality.duplicate_counts(df, ["id"], "test_table").first()
    assert (r["row_count"], r["distinct_keys"], r["duplicate_count"]) == (4, 3, 1)
    assert keep_first(df, ["id"]).count() == 3
    clean = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, value string")
    assert quality.duplicate_counts(clean, ["id"], "t").first()["duplicate_count"] == 0


def test_keep_first_respects_sequence_and_null_keys(spark):
    df = spark.createDataFrame([(None, "x", 2), (None, "y", 1), (1, "late", 9), (1, "early", 3)],
                               "k int, v string, seq int")
    got = {r["k"]: r["v"] for r in keep_first(df, ["k"], ["seq"]).collect()}
    assert got == {None: "y", 1: "early"}  # nulls compare equal, first by seq


def test_blank_ids_are_not_merged(spark):
    # Q22: rows without a real id share a key but are all kept
    df = spark.createDataFrame([("", "k0", 1), ("", "k0", 2), ("  ", "k0", 3), ("t1", "k1", 4), ("t1", "k1", 5)],
                               "tid string, key string, seq int")
    out = keep_first_with_id(df, ["key"], "tid", ["seq"])
    assert out.count() == 4
    assert out.filter(F.col("tid") == "t1").first()["seq"] == 4


def test_amount_stats_fixture(spark):
    df = spark.createDataFrame([(100,), (-50,), (200,), (300,)], "amount long")
    r = quality.amount_stats(df, ["amount"], "test").first()
    assert r["mean"] == 137.5 and r["median"] == 150.0
    assert r["std"] == pytest.approx(149.30, abs=0.01)
    assert r["negative_count"] == 1 and r["outlier_count"] == 0
    r2 = quality.amount_stats(spark.createDataFrame([(100,), (-50,), (200,), (-300,)], "amount long"),
                              ["amount"], "test", allow_negative=True).first()
    assert r2["mean"] == -12.5 and r2["median"] == 25.0 and r2["negative_count"] is None
    assert r2["std"] == pytest.approx(217.47, abs=0.01)


def test_amount_stats_outliers_and_single_row(spark):
    rows = [(10,)] * 30 + [(10_000,)]
    r = quality.amount_stats(spark.createDataFrame(rows, "a long"), ["a"], "t").first()
    assert r["outlier_count"] == 1 and r["median"] == 10.0
    one = quality.amount_stats(spark.createDataFrame([(5,)], "a long"), ["a"], "t").first()
    assert one["std"] is None and one["outlier_count"] == 0 and one["median"] == 5.0


def test_median_even_and_odd(spark):
    import numpy as np
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9]
    for n in (1, 2, 7, 15):
        df = spark.createDataFrame([(v,) for v in vals[:n]], "a long")
        assert quality.amount_stats(df, ["a"], "t").first()["median"] == float(np.median(vals[:n]))


def test_date_range(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 5, 1),), (dt.datetime(2024, 6, 1),), (dt.datetime(2024, 7, 2, 12),),
                                (None,)], "d timestamp_ntz")
    r = quality.date_range(df, "d", "t", as_of="2024-07-01 00:00:00").first()
    assert r["min_value"] == dt.datetime(2019, 5, 1) and r["max_value"] == dt.datetime(2024, 7, 2, 12)
    # outside [2020-01-01, 2024-07-02 00:00]: 2019 and 2024-07-02 12:00
    assert r["out_of_range_count"] == 2 and r["future_count"] == 1


def test_quality_report_long_table(spark):
    df = spark.createDataFrame([(1, 10), (None, 20)], "id int, a long")
    rep = quality.quality_report([quality.null_counts(df, ["id"], "t")], [quality.duplicate_counts(df, ["id"], "t")],
                                 [], [quality.amount_stats(df, ["a"], "t")])
    got = {(r["check_name"], r["column_name"]): r["value"] for r in rep.collect()}
    assert got[("nulls", "id")] == 1.0 and got[("duplicates", "id")] == 0.0 and got[("mean", "a")] == 15.0


def test_amount_histogram_is_built_once(spark, tmp_dir):
    # every reader of the histogram takes the same exchange, so each table is read once
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    spark.range(500).selectExpr("if(id % 9 = 0, null, id * 3 - 20) as p", "id / 7 as q").write.parquet(a)
    spark.range(300).selectExpr("id % 40 as p").write.parquet(b)
    rep = quality.amount_stats_many([(spark.read.parquet(a), ["p", "q", "absent"], "ta", False),
                                     (spark.read.parquet(b), ["p"], "tb", True)])
    got = {(r["table_name"], r["column_name"]): r for r in rep.collect()}
    assert set(got) == {("ta", "p"), ("ta", "q"), ("tb", "p")}
    assert got["ta", "p"]["value_count"] == 444 and got["ta", "p"]["negative_count"] == 6
    assert got["tb", "p"]["negative_count"] is None and got["tb", "p"]["mean"] == 18.8333
    final = rep._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 2


def test_report_reads_a_table_once_for_all_its_amounts(spark, tmp_dir):
    # a profile, a duplicate check and the amounts: three reads, not one more for the median
    spark.range(200).selectExpr("id % 150 as k", "if(id % 5 = 0, null, id) as a", "id * 1.5D as b").write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    rep = quality.quality_report(dups=[quality.duplicate_counts(df, ["k"], "t")],
                                 amounts=[quality.amount_stats_many([(df, ["a", "b"], "t", False)])],
                                 profiles=[quality.table_profile(df, "t", ["k", "a"])])
    got = {(r["check_name"], r["column_name"]): r["value"] for r in rep.collect()}
    assert got["nulls", "a"] == 40.0 and got["duplicates", "k"] == 50.0 and got["median", "b"] == 149.25
    assert got["mean", "a"] == 100.0 and got["outlier_count", "a"] == 0.0
    final = rep._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 3


def _rows_exchanged(plan) -> list[int]:
    """Rows written by every exchange of an executed plan."""
    found, kind = [], plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _rows_exchanged(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _rows_exchanged(plan.plan())
    if kind == "ShuffleExchangeExec":
        found.append(plan.metrics().apply("shuffleRecordsWritten").value())
    kids = plan.children()
    for i in range(kids.size()):
        found += _rows_exchanged(kids.apply(i))
    return found


def test_amounts_without_repeats_travel_once_per_row(spark, tmp_dir):
    # a histogram of distinct values has as many rows as the table has amounts, and was read five times
    n = 20_000
    spark.range(n).selectExpr("1000000 + id * 0.25D as p", "500000 - id / 7 as q", f"if(id % 3 = 0, 3000 + id / {n}, 0) as r") \
         .write.parquet(tmp_dir + "/t")
    rep = quality.amount_stats(spark.read.parquet(tmp_dir + "/t"), ["p", "q", "r"], "t")
    got = {r["column_name"]: r for r in rep.collect()}
    assert got["p"]["median"] == 1002499.875 and got["r"]["median"] == 0.0 and got["q"]["outlier_count"] == 0
    rows = _rows_exchanged(rep._jdf.queryExecution().executedPlan())
    assert rows.count(n) == 1 and max(rows) == n and sum(rows) < 1.5 * n


def test_amount_stats_match_numpy_on_skewed_values(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    columns = {
        "tail": np.round(rng.lognormal(8, 2, 3000), 2),
        "sides": np.concatenate([rng.normal(0, 1, 2990), rng.normal(0, 40, 10)]),
        "near": 1e9 + np.round(rng.normal(0, 100, 3000), 1),
        "few": rng.choice([0.0, -0.0, 1.0, -5.0, 900.0], 3000, p=[.5, .2, .2, .09, .01]),
        "tiny": np.concatenate([rng.normal(0, 1e-6, 2998), [3e-4, -3e-4]]),
        "same": np.full(3000, 7.0)}
    df = spark.createDataFrame(list(zip(*(v.tolist() for v in columns.values()), strict=True)),
                               ", ".join(f"{c} double" for c in columns))
    got = {r["column_name"]: r for r in quality.amount_stats(df.repartition(3), list(columns), "t").collect()}
    for c, v in columns.items():
        std = v.std(ddof=1)
        far = int((np.abs(v - v.mean()) > 3 * std).sum()) if std > 0 else 0
        assert got[c]["value_count"] == 3000 and got[c]["negative_count"] == int((v < 0).sum()), c
        assert got[c]["outlier_count"] == far and got[c]["median"] == pytest.approx(np.median(v), rel=1e-15), c
        assert got[c]["std"] == pytest.approx(std, abs=0.006) and got[c]["mean"] == pytest.approx(v.mean(), rel=1e-9, abs=6e-5), c
