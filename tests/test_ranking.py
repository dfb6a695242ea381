"""Exact rank without a single-partition sort (H2) and quintile rules (Q6)."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwise.operators.ranking import exact_rank, ntile_bucket, qcut_bucket


def test_exact_rank_equals_row_number_with_skew(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        part = 0 if i % 3 else rnd.randint(1, 20)  # partition 0 holds two thirds of the rows
        val = rnd.choice([5, 5, 5, 7, None, rnd.randint(-10**9, 10**9)])
        rows.append((part, val, i * 7919 % 100003))
    df = spark.createDataFrame(rows, "p int, v long, t long")
    got = exact_rank(df, "v", "t", partition_by=["p"], count_col="n")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("p").orderBy(
        F.col("v").asc_nulls_first(), "t"))).withColumn("n2", F.count(F.lit(1)).over(Window.partitionBy("p")))
    diff = got.drop("v").join(want, ["p", "t"], "full").filter((F.col("rank") != F.col("rn")) | (F.col("n") != F.col("n2"))
                                                            | F.col("rank").isNull() | F.col("rn").isNull())
    assert diff.count() == 0


def test_exact_rank_global_and_text_tie(spark):
    rows = [(i % 4, f"{(i * 37) % 1000:04x}-{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "v long, t string")
    got = {r["t"]: r["rank"] for r in exact_rank(df, "v", "t").collect()}
    srt = sorted(rows, key=lambda x: (x[0], x[1]))
    assert all(got[t] == i + 1 for i, (_, t) in enumerate(srt))


def test_exact_rank_plan_has_no_row_level_single_partition(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("v"), F.col("id").alias("t"))
    plan = exact_rank(df, "v", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # only over the small group table
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _pandas_qcut(n):
    if n == 1:
        return [1]
    return list(pd.qcut(pd.Series(range(1, n + 1)), q=5, labels=[1, 2, 3, 4, 5]).astype(int))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 11, 12, 13, 14, 29, 57, 101, 1363])
def test_qcut_bucket_matches_quantile_cut(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).cast("bigint").alias("n"))
    got = [r[0] for r in df.orderBy("r").select(qcut_bucket(F.col("r"), F.col("n"))).collect()]
    assert got == _pandas_qcut(n)


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 11, 13, 23])
def test_ntile_bucket_matches_ntile(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).cast("bigint").alias("n"))
    got = df.select("r", ntile_bucket(F.col("r"), F.col("n")).alias("b"),
                    F.ntile(5).over(Window.orderBy("r")).alias("want")).collect()
    assert all(r["b"] == r["want"] for r in got)


def test_qcut_differs_from_ntile_when_n_mod_5_is_3(spark):
    assert _pandas_qcut(8) != [1, 1, 2, 2, 3, 3, 4, 5]


def test_sparse_ids_of_a_heavy_value_stay_on_the_grid(spark):
    from martwise.operators.ranking import log_grid
    spread = F.xxhash64("id").alias("key")  # ids over the whole 64-bit range, below zero too
    df = spark.range(20000).select(spread, F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 7).alias("v"))
    got = exact_rank(df, "v", "key").collect()
    want = {k: i + 1 for i, (_, k) in enumerate(sorted((r["v"], r["key"]) for r in got))}
    assert all(r["rank"] == want[r["key"]] for r in got)
    top = spark.range(200000).select(log_grid((F.lit(1 << 62) + F.col("id") * (1 << 44)).cast("bigint")).alias("g"))
    cells = top.groupBy("g").count().agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).first()
    assert cells["n"] <= 2 * 2048 and cells["most"] <= 400
