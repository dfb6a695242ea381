"""Gold tables co-located on a key (J1-J3, J6, B12): dealt out by the key once, when written.

Joins and groups on the key then read bucket beside bucket, with no shuffle of
the tables.  A bucket is read by one task, so a key with more rows than an
average bucket must not be in one: such *hot* keys, and rows without a key,
are kept in a plain part beside the buckets, which is read by as many tasks as
it needs.  There are fewer hot keys than buckets (each holds more than one
bucket's share), so what is aggregated or looked up by hot key may be broadcast.

Layout: ``<root>/<table>__versions/<version>`` has the buckets,
``<root>/<table>__hot/<version>`` the other rows and the list of hot keys.
The catalog entry names the buckets' folder and so both parts: a write is
seen whole or not at all, as in ``versions``.

Defined cases: equal rows all stay; an empty frame leaves a table that exists
as it is (K2) and makes an empty one else; a table may be all hot or have no hot key.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martwise.sinks.tables import delete_path
from martwise.sinks.versions import (
    _described, _name, drop_old_versions, quoted, table_location, versions_root,
)

# A key with fewer rows than this is no burden to a task, however small the buckets are.
HOT_ROWS = 100_000


@dataclass(frozen=True)
class Colocated:
    """The parts of a co-located table; a key is in one of them only."""

    key: str
    buckets: int
    rows: DataFrame  # bucketed on the key
    hot: DataFrame  # rows of hot keys, and rows without a key
    hot_keys: DataFrame  # fewer than there are buckets

    def whole(self) -> DataFrame:
        return self.rows.unionByName(self.hot)

    def of_hot_keys_of(self, other: Colocated) -> DataFrame:
        """The rows, from both parts, whose key is hot in ``other``."""
        return self.whole().join(F.broadcast(other.hot_keys), self.key, "left_semi")


def _hot_folder(spark: SparkSession, table: str, version: str) -> str:
    database, name = _name(spark, table)
    return f"{version.rstrip('/').rsplit('/', 2)[0]}/{name}__hot/{version.rstrip('/').rsplit('/', 1)[-1]}"


def _buckets(spark: SparkSession, table: str) -> tuple[str, str] | None:
    columns = _described(spark, table, "Bucket Columns")
    return (columns.strip("[]").replace("`", ""), _described(spark, table, "Num Buckets")) if columns else None


def hot_keys(df: DataFrame, key: str, buckets: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with more rows than a bucket has on average, and than ``hot_rows``."""
    limit = max(df.count() / buckets, hot_rows)
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > F.lit(float(limit))).select(key))


def publish_colocated(df: DataFrame, table: str, key: str, buckets: int, sort_by: Sequence[str] = (),
                      root: str | None = None, hot_rows: int = HOT_ROWS) -> int:
    """Write ``df`` co-located on ``key`` as the table's next version; returns the rows.

    ``df`` is read three times (keys, buckets, hot rows): pass a written
    table rather than the plan that makes one.  Tables to be joined need the
    same number of buckets; size it so that a bucket fits a task.
    """
    spark = df.sparkSession
    name = quoted(spark, table)
    known = spark.catalog.tableExists(name)
    if known and df.isEmpty():
        return 0
    version = f"{versions_root(spark, table, root)}/{int(time.time() * 1000):015d}-{uuid.uuid4().hex}"
    beside = _hot_folder(spark, table, version)
    hot_keys(df, key, buckets, hot_rows).repartition(1).write.parquet(f"{beside}/keys")  # fewer rows than buckets
    hot = F.broadcast(spark.read.schema(df.select(key).schema).parquet(f"{beside}/keys"))
    obs = [Observation(), Observation()]
    count = F.count(F.lit(1)).alias("rows")
    without = df.filter(F.col(key).isNull())
    df.join(hot, key, "left_semi").select(*df.columns).unionByName(without).observe(obs[0], count) \
        .write.parquet(f"{beside}/rows")
    rest = df.filter(F.col(key).isNotNull()).join(hot, key, "left_anti").select(*df.columns)
    # a partition holds whole buckets; AQE joins small ones and parts large ones, then a bucket has several files
    dealt = rest.hint("rebalance", buckets, F.col(key)).observe(obs[1], count)
    database, plain = _name(spark, table)
    staged = f"`{database}`.`{plain}__{uuid.uuid4().hex[:12]}`"
    writer = dealt.write.format("parquet").bucketBy(buckets, key).option("path", version)
    (writer.sortBy(key, *[c for c in sort_by if c != key]) if sort_by else writer.sortBy(key)).saveAsTable(staged)
    same = known and spark.table(name).schema == spark.table(staged).schema \
        and _buckets(spark, table) == _buckets(spark, staged)
    if same:  # the commit is one operation
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.sql(f"DROP TABLE {staged}")  # its files stay, they are the table's now
    else:  # another layout (K3)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    return sum(int(o.get["rows"]) for o in obs)


def open_colocated(spark: SparkSession, table: str) -> Colocated:
    """Both parts of the version that the catalog names now."""
    spec = _buckets(spark, table)
    if spec is None:
        raise ValueError(f"{table} is not co-located on a key")
    key, buckets = spec
    rows = spark.table(quoted(spark, table))
    beside = _hot_folder(spark, table, table_location(spark, table))
    return Colocated(key, int(buckets), rows, spark.read.schema(rows.schema).parquet(f"{beside}/rows"),
                     spark.read.schema(rows.select(key).schema).parquet(f"{beside}/keys"))


def drop_old_colocated(spark: SparkSession, table: str, keep: int = 1, root: str | None = None) -> list[str]:
    """Remove versions before the current one but for the last ``keep``, both parts of each; returns them."""
    gone = drop_old_versions(spark, table, keep, root)
    for version in gone:
        delete_path(spark, _hot_folder(spark, table, version))
    return gone


__all__ = ["Colocated", "HOT_ROWS", "drop_old_colocated", "hot_keys", "open_colocated", "publish_colocated"]
