"""Sinks and catalog operations K1-K8.

Gold tables are Parquet datasets partitioned by a derived day column and
sorted by their clustering columns inside each file (min/max statistics
then skip row groups for filters on those columns).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martwise.operators.zorder import Z, with_z

log = logging.getLogger("martwise.sinks")

# Write dispositions of the warehouse API, mapped to Spark save modes.
WRITE_MODES = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append", "WRITE_EMPTY": "errorifexists"}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds anything, asked of the path's own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this module wrote, through its own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def day_column(field: str) -> str:
    return f"{field}_day"


def write_table(df: DataFrame, path: str, write_disposition: str = "WRITE_TRUNCATE",
                partition_field: str | None = None,
                clustering_fields: Sequence[str] | None = None,
                empty_probe: DataFrame | None = None, metrics: dict | None = None,
                found: dict | None = None, space_filling: bool = False) -> int:
    """K1 + K2 + K3: write ``df`` to ``path``; returns the rows written.

    * Empty input: nothing is written, the old target stays, 0 (K2).  The
      emptiness test is a one-row job; on a plan with a shuffle it would
      run the plan up to that shuffle once more, so callers pass
      ``empty_probe``, a cheap frame that is empty exactly when ``df`` is
      (e.g. the raw scan a gold table is built from: reading one row).
    * ``partition_field``: partitioned by ``<field>_day = to_date(field)``.
      Rows are *rebalanced* on the day (AQE splits a day holding a large
      share of the rows over several tasks instead of one) and sorted by
      day and clustering fields inside each task, so each task writes one
      sorted file per day it holds.
    * Fields missing from the frame are ignored, as the warehouse did.
    * A whole-path overwrite replaces any earlier layout (K3).
    * ``space_filling``: sort by a space-filling order of the clustering fields
      instead of field by field (``operators.zorder``), so that filters on any
      of them skip row groups; an unpartitioned table is also range-partitioned on it.
    The row count comes from an observation of the write job itself: no
    second pass over the data.  So do ``metrics``, further aggregates by any
    key, whose values are put into ``found``.
    """
    mode = WRITE_MODES.get(write_disposition, write_disposition)
    if (empty_probe if empty_probe is not None else df).isEmpty():
        log.warning("empty input for %s: skipped", path)
        return 0
    cluster = [c for c in (clustering_fields or []) if c in df.columns]
    part_cols: list[str] = []
    out = df
    if partition_field and partition_field in df.columns:
        day = day_column(partition_field)
        out = out.withColumn(day, F.to_date(F.col(partition_field)))
        part_cols = [day]
        out = out.hint("rebalance", day)
    if space_filling and cluster:
        out = with_z(out, cluster)
        if not part_cols:
            out = out.repartitionByRange(Z)
        out = out.sortWithinPartitions(*part_cols, Z).drop(Z)
    elif part_cols or cluster:
        out = out.sortWithinPartitions(*part_cols, *cluster)
    obs = Observation("rows_written")
    extra = list((metrics or {}).items())
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(f"m{i}") for i, (_, c) in enumerate(extra)])
    # a session set to dynamic overwrite would leave days that are gone from the data
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static")
    if part_cols:
        writer = writer.partitionBy(*part_cols)
    writer.parquet(path)
    if found is not None:
        found.update({k: obs.get[f"m{i}"] for i, (k, _) in enumerate(extra)})
    return int(obs.get["rows"])


def read_table(spark: SparkSession, path: str, day_from=None, day_to=None,
               partition_field: str | None = None) -> DataFrame:
    """Read a gold table; a day range on its partition field becomes a
    filter on the ``_day`` partition column, so whole directories are
    pruned before any file is opened."""
    df = spark.read.parquet(path)
    if partition_field and (day_from or day_to):
        day = F.col(day_column(partition_field))
        if day_from:
            df = df.filter(day >= F.lit(str(day_from)).cast("date"))
        if day_to:
            df = df.filter(day <= F.lit(str(day_to)).cast("date"))
    return df


def create_database_if_not_exists(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K4."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def save_as_table(df: DataFrame, table: str, write_disposition: str = "WRITE_TRUNCATE",
                  partition_field: str | None = None, empty_probe: DataFrame | None = None) -> int:
    """K1/K3 against the catalog: an overwrite is a new version that the table
    moves to when it is whole, whatever the old layout was (``versions``)."""
    from martwise.sinks.versions import save_table

    return save_table(df, table, write_disposition, partition_field, empty_probe=empty_probe)


def execute_query(spark: SparkSession, sql: str) -> DataFrame:
    """K5: run SQL, return the (lazy) result."""
    return spark.sql(sql)


def create_views(views: dict[str, Callable[[], DataFrame]]) -> dict[str, bool]:
    """K6 for this session (``plans.view_sql.store_views`` for the catalog): create or replace each view; a view that fails to build is
    logged and skipped, the others are still created."""
    done = {}
    for name, build in views.items():
        try:
            build().createOrReplaceTempView(name)
            done[name] = True
        except Exception as ex:  # keep going, like the source did
            log.error("view %s failed: %s", name, ex)
            done[name] = False
    return done


def table_info(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """K7: one row (table_name, num_rows, num_bytes, created, modified).

    No row is read: the count is pushed into the Parquet reader and summed
    from the files' footers, sizes and times are those of the file listing.
    'created' is the oldest file, 'modified' the newest."""
    rows = footer_rows(spark, path).first()[0] or 0  # one number; null where no file has a footer with rows
    files = spark.read.format("binaryFile").load(path).select("length", "modificationTime")  # contents are not read
    return files.agg(F.lit(name or path).alias("table_name"), F.lit(rows).cast("bigint").alias("num_rows"),
                     F.sum("length").cast("bigint").alias("num_bytes"), F.min("modificationTime").alias("created"),
                     F.max("modificationTime").alias("modified"))


# Reading Parquet through the second reader interface, the one that takes aggregates.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
               "spark.sql.parquet.aggregatePushdown": "true"}


def footer_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a Parquet table from its footers, planned in a session of
    its own so that the caller's settings stay."""
    own = spark.newSession()
    for k, v in FOOTER_CONF.items():
        own.conf.set(k, v)
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("num_rows"))


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder within its file system; an error if that fails."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


def _set_aside(path: str) -> str:
    return path.rstrip("/") + "__replaced"


def recover_table(spark: SparkSession, path: str) -> bool:
    """Put back the table that a replace had set aside when it was cut off; true if it did."""
    if path_exists(spark, path) or not path_exists(spark, _set_aside(path)):
        return False
    rename_path(spark, _set_aside(path), path)
    return True


def replace_table(df: DataFrame, path: str, partition_field: str | None = None,
                  clustering_fields: Sequence[str] | None = None, staging_root: str | None = None,
                  empty_probe: DataFrame | None = None, metrics: dict | None = None, found: dict | None = None) -> int:
    """K8 / H8: overwrite a table with a frame that reads that same table.

    The result is written whole to a staging path in the same file system,
    once.  Then the live folder is set aside and the staging folder renamed to
    its place.  A job that dies while writing leaves the live table as it was;
    one that dies between the two renames leaves it set aside, and
    ``recover_table`` (called here and by the readers of the gold tables) puts
    it back.  Where renaming a folder copies it (object stores), or where
    readers may not see the gap, publish versions in the catalog instead
    (``versions.publish_table``)."""
    spark = df.sparkSession
    recover_table(spark, path)
    staging = f"{staging_root or path.rstrip('/') + '__staging'}/{uuid.uuid4().hex}"
    if partition_field and day_column(partition_field) in df.columns:
        df = df.drop(day_column(partition_field))
    n = write_table(df, staging, "WRITE_EMPTY", partition_field, clustering_fields, empty_probe, metrics, found)
    if n == 0:
        return 0
    if path_exists(spark, path):
        delete_path(spark, _set_aside(path))  # left by a replace that ended after its renames
        rename_path(spark, path, _set_aside(path))
    try:
        rename_path(spark, staging, path)
    except Exception:
        recover_table(spark, path)
        raise
    delete_path(spark, _set_aside(path))
    return n
