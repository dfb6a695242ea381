"""Incremental cart-event ingest with Structured Streaming.

The source read one huge export in chunks and transformed each chunk on
its own (B10).  Here new export files under a directory are the stream:
``maxFilesPerTrigger`` bounds a micro-batch, each micro-batch runs the
batch builder (B9) and is appended to the gold table, and the checkpoint
makes the ingest exactly-once across restarts and lost executors: a batch
that fails is re-run from its recorded file list, and a batch id already
committed to the sink is skipped.

A micro-batch removes the duplicates it sees, and of the rest those that
an earlier batch has stored: the first ingested stays, each key is in the
stored table once, and what is stored is what the batch builder makes of all
the files.  The batch is held against the keys alone, one column of the
slices of earlier batch ids, so a batch that is run again meets the same
keys.  ``repeat_days`` says how many days apart by event time an event and its
repeat may be; then only the day folders within reach of the batch are read,
and work stays that of the batch however old the table is.  Without it
the keys of all days are read.

``dedup_watermark`` (new behaviour, not in the source): drop events whose
event_id was already seen within that much event time, across batches,
with ``dropDuplicatesWithinWatermark``; the state it keeps is bounded by
the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martwise import schemas
from martwise.operators.dedup import keep_first
from martwise.plans.facts import fact_cart_events
from martwise.sinks.tables import day_column, write_table
from martwise.sources.json_chunks import stream_json_chunked


def cart_event_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1,
                      dedup_watermark: str | None = None) -> DataFrame:
    """Streaming frame of raw cart-event records with their file and place in
    it, the same as the batch reader gives (B10)."""
    raw = stream_json_chunked(spark, source_dir, schemas.RAW_CART_EVENT, max_files_per_trigger)
    if dedup_watermark:
        raw = (raw.withColumn("_wm_ts", F.try_to_timestamp(F.col("timestamp")))
                  .withWatermark("_wm_ts", dedup_watermark)
                  .dropDuplicatesWithinWatermark(["event_id"])
                  .drop("_wm_ts"))
    return raw


SLICE = "ingest_batch="
DAY = day_column("event_timestamp")


def _slices_before(spark: SparkSession, target_path: str, batch_id: int) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(target_path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    names = [f.getPath().getName() for f in system.listStatus(at)]
    return [f"{target_path.rstrip('/')}/{n}" for n in names if n.startswith(SLICE) and int(n[len(SLICE):]) < batch_id]


def stored_keys(spark: SparkSession, target_path: str, batch_id: int, reach: tuple | None = None) -> DataFrame | None:
    """Event keys of the batches before ``batch_id``; with ``reach``, a first and a last day, of events of
    those days and of events without a time.  None before the first batch."""
    slices = _slices_before(spark, target_path, batch_id)
    if not slices:
        return None
    keys = spark.read.schema(f"event_key string, {DAY} date").option("basePath", target_path).parquet(*slices)
    if reach is not None:
        keys = keys.filter(F.col(DAY).isNull() | F.col(DAY).between(*[F.lit(d).cast("date") for d in reach]))
    return keys.select("event_key")


def not_stored(built: DataFrame, target_path: str, batch_id: int, repeat_days: int | None = None) -> DataFrame:
    """The events of a batch whose key no earlier batch has stored."""
    reach = None
    if repeat_days is not None:
        days = built.agg(F.date_sub(F.min(F.to_date("event_timestamp")), repeat_days).cast("string"),
                         F.date_add(F.max(F.to_date("event_timestamp")), repeat_days).cast("string"),
                         F.count_if(F.col("event_timestamp").isNull())).first()  # one row
        if not days[2]:  # an event without a time may repeat one of any day
            reach = (days[0], days[1])
    keys = stored_keys(built.sparkSession, target_path, batch_id, reach)
    return built if keys is None else built.join(keys, "event_key", "left_anti").select(*built.columns)


def _batch_writer(target_path: str, repeat_days: int | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the probe, the days and the write read the files, and the watermark's state, once
        try:
            # idempotent per batch id: a re-run batch overwrites its own slice only
            write_table(not_stored(fact_cart_events(batch), target_path, batch_id, repeat_days),
                        f"{target_path.rstrip('/')}/{SLICE}{batch_id}", "WRITE_TRUNCATE",
                        "event_timestamp", ("customer_id", "session_id", "event_type"), empty_probe=batch)
        finally:
            batch.unpersist()
    return write


def start_cart_event_ingest(spark: SparkSession, source_dir: str, target_path: str, checkpoint: str,
                            max_files_per_trigger: int = 1, available_now: bool = True,
                            processing_time: str | None = None,
                            dedup_watermark: str | None = None, repeat_days: int | None = None) -> StreamingQuery:
    """Start T1; ``available_now`` processes what is there and stops (the
    batch-like mode), else it triggers every ``processing_time``.
    ``repeat_days`` bounds how far by event time repeats are looked for."""
    stream = cart_event_stream(spark, source_dir, max_files_per_trigger, dedup_watermark)
    w = stream.writeStream.foreachBatch(_batch_writer(target_path, repeat_days)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def read_ingested(spark: SparkSession, target_path: str, merge: bool = False) -> DataFrame:
    """The gold table the stream wrote: all batches, each event key once, with
    no shuffle.  Events without an id have their file and position in the key
    and all stay.  ``merge``: for tables that an ingest has written which
    did not hold batches against stored keys, or bounded ``repeat_days``
    too narrowly: of a key's rows the first ingested."""
    slices = spark.read.option("basePath", target_path).parquet(f"{target_path.rstrip('/')}/{SLICE}*")
    return keep_first(slices, ["event_key"], ["ingest_batch"]) if merge else slices
