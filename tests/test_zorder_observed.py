"""K1 in a space-filling order, checks observed by the write, copies written out in steps."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martwise.operators import zorder
from martwise.operators.dedup import keep_first_with_id
from martwise.plans import checks
from martwise.plans.gold import RawJsonGold
from martwise.plans.jobs import quality_checks, read_gold, write_gold
from martwise.sinks import tables as sinks
from tests import fixtures


def groups_read(path, column, low, high):
    """Row groups that a filter low <= column <= high cannot skip, of all."""
    read = total = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            read += stats.max >= low and stats.min <= high
    return read, total


def test_filters_on_each_of_three_fields_skip_row_groups(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(rng.randrange(100_000), rng.gauss(0, 1), f"s{rng.randrange(50_000):05d}") for _ in range(60_000)]
    df = spark.createDataFrame(rows, "a long, b double, c string").coalesce(1)
    old = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "20000")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size.row.check.min", "100")
    try:
        for name, filling in (("z", True), ("lex", False)):
            assert sinks.write_table(df, f"{tmp_dir}/{name}", clustering_fields=["a", "b", "c"], space_filling=filling) == 60_000
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        conf.unset("parquet.block.size") if old is None else conf.set("parquet.block.size", old)
    wanted = {"a": (40_000, 41_000), "b": (0.5, 0.51), "c": ("s20000", "s20100")}
    share = {}
    for name in ("z", "lex"):
        got = {c: groups_read(f"{tmp_dir}/{name}", c, *w) for c, w in wanted.items()}
        assert all(total > 20 for _, total in got.values())
        share[name] = {c: read / total for c, (read, total) in got.items()}
    assert all(s <= 0.6 for s in share["z"].values()), share
    assert share["lex"]["c"] == 1 and share["lex"]["b"] == 1, share
    back = spark.read.parquet(f"{tmp_dir}/z")
    assert back.columns == ["a", "b", "c"] and back.exceptAll(df).count() == 0


def test_space_filling_within_days_and_odd_values(spark, tmp_dir):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"), F.lit(None).cast("string").alias("nothing"),
        (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_interval(days=(F.col("id") % 3).cast("int"))).alias("ts"),
        F.concat(F.lit("é"), F.col("id") % 11).alias("t"), F.to_date(F.lit("2025-01-01")).alias("d"))
    n = sinks.write_table(df, f"{tmp_dir}/t", "WRITE_TRUNCATE", "ts", ["id", "nothing", "t", "d", "absent"], space_filling=True)
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert n == 3000 and len(glob.glob(f"{tmp_dir}/t/ts_day=*")) == 3
    assert back.drop("ts_day").exceptAll(df).count() == 0 and zorder.Z not in back.columns
    assert sinks.write_table(df.limit(0), f"{tmp_dir}/none", clustering_fields=["id"], space_filling=True) == 0


@pytest.fixture(scope="module")
def gold(spark):
    import tempfile

    folder = tempfile.mkdtemp(prefix="martwise-test-", dir="/tmp")
    return folder, RawJsonGold(spark, fixtures.write_exports(f"{folder}/exports"))


def test_observed_checks_equal_the_checks_that_read(spark, gold):
    folder, g = gold
    as_of = "2025-04-01 00:00:00"
    observed = {}
    write_gold(g, f"{folder}/gold", as_of=as_of, observed=observed)
    assert set(checks.NULL_COLUMNS) <= set(observed)
    t = read_gold(spark, f"{folder}/gold")
    key = lambda r: (r["table_name"], r["check_name"], r["column_name"])
    got = {key(r): r["value"] for r in quality_checks(t, as_of, observed).collect()}
    want = {key(r): r["value"] for r in quality_checks(t, as_of).collect()}
    assert got == want and any(v > 0 for k, v in got.items() if k[1] == "nulls") and ("fact_orders", "blank_ids", "order_id") in got
    scans = quality_checks(t, as_of, observed)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans < quality_checks(t, as_of)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_copies_of_rows_without_an_id_are_written_out(spark):
    for n in (1, 2, 3, 10, 99, 100, 101, 1000):
        df = spark.range(n).select(F.lit(" ").alias("id"), F.lit(5).alias("x")).coalesce(1)
        assert keep_first_with_id(df, ["id"], "id").count() == n
