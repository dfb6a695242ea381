"""The stored slices hold each event once.  K7: table info without reading rows."""

import shutil

from pyspark.sql import functions as F

from martwise import schemas
from martwise.plans.facts import fact_cart_events
from martwise.sinks import tables as sinks
from martwise.sources import json_sources as js
from martwise.streaming import cart_stream, read_ingested, start_cart_event_ingest
from tests import fixtures


def event(key, day=1, **more):
    return dict(fixtures.CART[0], event_id=key, session_id="s", **{"timestamp": f"2025-03-{day:02d}T10:00:00Z", **more})


def write(src, i, events):
    fixtures.write_json_gz(f"{src}/part-{i}.json.gz", events)


def stored(spark, target):
    return read_ingested(spark, target)


def test_slices_hold_each_key_once_over_restarts(spark, tmp_dir):
    src, target, ckpt = f"{tmp_dir}/events", f"{tmp_dir}/gold", f"{tmp_dir}/ckpt"
    files = [[event("a", device="first"), event("b"), event(None)], [event("a", device="again"), event("c"), event(None)],
             [event("a"), event("b"), event("c")], [event("d", day=9), event("c", device="late")]]
    for i, part in enumerate(files):
        write(src, i, part)
        start_cart_event_ingest(spark, src, target, ckpt).awaitTermination(300)  # stopped and started for each file
    got = stored(spark, target)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 6 == got.select("event_key").distinct().count()
    assert sorted((r["event_id"], r["ingest_batch"]) for r in got.collect() if r["event_id"]) == [
        ("a", 0), ("b", 0), ("c", 1), ("d", 3)]
    assert [r["device"] for r in got.filter("event_id = 'a'").collect()] == ["first"]
    batch = fact_cart_events(js.read_json_gzip(spark, [f"{src}/part-{i}.json.gz" for i in range(4)], schemas.RAW_CART_EVENT))
    cols = sorted(set(batch.columns) - {"event_key"})
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, batch.select(cols).collect()))
    assert sorted(map(str, read_ingested(spark, target, merge=True).select(cols).collect())) == sorted(
        map(str, got.select(cols).collect()))


def test_a_batch_run_again_writes_the_same(spark, tmp_dir):
    target = f"{tmp_dir}/gold"
    raw = [spark.createDataFrame([(k, "s", "2025-03-01T10:00:00Z") for k in keys], "event_id string, session_id string, timestamp string")
           for keys in (["a", "b"], ["b", "c"], ["c", "d"])]
    for i in (0, 1, 2, 1):  # batch 1 once more, with a later one stored
        cart_stream._batch_writer(target, None)(raw[i], i)
    assert sorted((r["event_id"], r["ingest_batch"]) for r in stored(spark, target).collect()) == [
        ("a", 0), ("b", 0), ("c", 1), ("d", 2)]
    shutil.rmtree(f"{target}/ingest_batch=2")  # as a batch that was lost before it was written
    cart_stream._batch_writer(target, None)(raw[2], 2)
    assert stored(spark, target).count() == 4


def test_reach_in_days_prunes_the_stored_keys(spark, tmp_dir):
    target = f"{tmp_dir}/gold"
    frame = lambda *events: spark.createDataFrame(
        [(k, "s", t) for k, t in events], "event_id string, session_id string, timestamp string")
    at = "2025-03-{:02d}T10:00:00Z".format
    cart_stream._batch_writer(target, 2)(frame(("old", at(1)), ("near", at(9)), ("timeless", None)), 0)
    cart_stream._batch_writer(target, 2)(frame(("old", at(10)), ("near", at(10)), ("new", at(10))), 1)
    got = sorted((r["event_id"], r["ingest_batch"]) for r in stored(spark, target).collect())
    assert got == [("near", 0), ("new", 1), ("old", 0), ("old", 1), ("timeless", 0)]  # nine days apart: beyond reach
    assert read_ingested(spark, target, merge=True).filter("event_id = 'old'").count() == 1
    keys = cart_stream.stored_keys(spark, target, 2, ("2025-03-08", "2025-03-12"))
    text = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "event_timestamp_day" in text.split("PartitionFilters")[1].split("]")[0]
    assert keys.count() == 4  # the first of March is not read; events without a time are
    # a batch with an event of no time looks through all days
    cart_stream._batch_writer(target, 2)(frame(("timeless", None), ("old", at(20))), 2)
    assert stored(spark, target).filter("ingest_batch = 2").count() == 0


def test_table_info_from_footers(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(1000).select("id", (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_interval(
        days=(F.col("id") % 4).cast("int"))).alias("ts"))
    sinks.write_table(df, path, "WRITE_TRUNCATE", "ts")
    counted = sinks.footer_rows(spark, path)
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in text and "ReadSchema: struct<count(*):bigint>" in text
    info = sinks.table_info(spark, path, "t").first()
    meta = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    want = meta.agg(F.sum("file_size"), F.min("file_modification_time"), F.max("file_modification_time")).first()
    assert (info["num_rows"], info["num_bytes"], info["created"], info["modified"]) == (1000, *want)
    assert info.asDict().keys() == {"table_name", "num_rows", "num_bytes", "created", "modified"}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was
    sinks.write_table(df.limit(0), f"{tmp_dir}/e", empty_probe=df)
    assert sinks.table_info(spark, f"{tmp_dir}/e").first()["num_rows"] == 0
