"""Catalog tables in versions (K1, K3, K8): readers see the old table or the new one.

A write goes to a new folder of its own beside the table's other versions.
Only when it is whole does the catalog entry move to it, in one metadata
operation (two where the columns change, K3), so a job that dies while writing
leaves the table as it was.  A
table may be replaced by a result that reads it.  A session that has resolved a table
reads that version until it refreshes the table, so the version before stays; ``drop_old_versions`` removes older
ones, and what failed writes left.

Layout: ``<root>/<table>__versions/<time>-<uuid>``, the root being the
database's location unless one is given.  Any Hadoop file system will do: no
folder is renamed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise.sinks.tables import WRITE_MODES, day_column, delete_path, write_table

FOLDER = "__versions"


def _name(spark: SparkSession, table: str) -> tuple[str, str]:
    parts = [p.strip("`") for p in table.split(".")]
    return (parts[-2], parts[-1]) if len(parts) > 1 else (spark.catalog.currentDatabase(), parts[-1])


def quoted(spark: SparkSession, table: str) -> str:
    return ".".join(f"`{p}`" for p in _name(spark, table))


def versions_root(spark: SparkSession, table: str, root: str | None = None) -> str:
    database, name = _name(spark, table)
    return f"{(root or spark.catalog.getDatabase(database).locationUri).rstrip('/')}/{name}{FOLDER}"


def _described(spark: SparkSession, table: str, row: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(spark, table)}").filter(F.col("col_name") == row).collect()
    return rows[-1]["data_type"] if rows else None


def table_location(spark: SparkSession, table: str) -> str | None:
    """Where the catalog says that the table is; None without such a table."""
    return _described(spark, table, "Location") if spark.catalog.tableExists(quoted(spark, table)) else None


# A table made with this off finds its partitions in its folders, so that moving the folder moves them too.
LISTED_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def _create(spark: SparkSession, name: str, folder: str) -> None:
    old = spark.conf.get(LISTED_PARTITIONS)
    spark.conf.set(LISTED_PARTITIONS, "false")
    try:
        spark.catalog.createTable(name, path=folder, source="parquet")
    finally:
        spark.conf.set(LISTED_PARTITIONS, old)


def _point(spark: SparkSession, table: str, folder: str) -> None:
    """The commit: the catalog entry moves to ``folder``."""
    name = quoted(spark, table)
    if not spark.catalog.tableExists(name):
        _create(spark, name, folder)
    else:
        old, new = spark.table(name).schema, spark.read.parquet(folder).schema
        same = [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]
        if same and _described(spark, table, "Partition Provider") is None:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        else:  # another layout (K3), or partitions that the catalog lists: a new entry; an external table's files stay
            spark.sql(f"DROP TABLE {name}")
            _create(spark, name, folder)
    spark.catalog.refreshTable(name)


def publish_table(df: DataFrame, table: str, partition_field: str | None = None,
                  clustering_fields: Sequence[str] | None = None, empty_probe: DataFrame | None = None,
                  root: str | None = None) -> int:
    """Write ``df`` as the table's next version and move the table to it; returns the rows.

    Empty input writes nothing and leaves the table (K2).  The day column of
    a partitioned table that ``df`` was read from is made anew.
    """
    spark = df.sparkSession
    if partition_field and day_column(partition_field) in df.columns:
        df = df.drop(day_column(partition_field))
    folder = f"{versions_root(spark, table, root)}/{int(time.time() * 1000):015d}-{uuid.uuid4().hex}"
    rows = write_table(df, folder, "WRITE_EMPTY", partition_field, clustering_fields, empty_probe)
    if rows:
        _point(spark, table, folder)
    return rows


def save_table(df: DataFrame, table: str, write_disposition: str = "WRITE_TRUNCATE", partition_field: str | None = None,
               clustering_fields: Sequence[str] | None = None, empty_probe: DataFrame | None = None,
               root: str | None = None) -> int:
    """K1 against the catalog: truncate publishes a version, append adds files to the current one, empty needs
    that there is no table yet."""
    spark = df.sparkSession
    mode = WRITE_MODES.get(write_disposition, write_disposition)
    at = table_location(spark, table)
    if mode == "errorifexists" and at is not None:
        raise ValueError(f"{table} exists")
    if mode == "append" and at is not None:
        rows = write_table(df, at, "append", partition_field, clustering_fields, empty_probe)
        spark.catalog.refreshTable(quoted(spark, table))
        return rows
    return publish_table(df, table, partition_field, clustering_fields, empty_probe, root)


def table_versions(spark: SparkSession, table: str, root: str | None = None) -> list[str]:
    """The version folders, oldest first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(versions_root(spark, table, root))
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in system.listStatus(at)) if system.exists(at) else []


def drop_old_versions(spark: SparkSession, table: str, keep: int = 1, root: str | None = None) -> list[str]:
    """Remove versions before the current one but for the last ``keep``; returns them.

    Later folders than the current one may belong to a job at work and stay.
    """
    current = (table_location(spark, table) or "").rstrip("/").rsplit("/", 1)[-1]
    before = [v for v in table_versions(spark, table, root) if v.rsplit("/", 1)[-1] < current]
    gone = before[:max(0, len(before) - keep)]
    for v in gone:
        delete_path(spark, v)
    return gone


__all__ = ["publish_table", "save_table", "table_location", "table_versions", "drop_old_versions", "versions_root", "quoted"]
