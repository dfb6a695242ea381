"""Helpers shared by the operators: shared storage, cut lineage, shipping."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import martwise

# Words of the text contracts: runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch: texts and pages are long, so a batch of the default
# 10,000 rows would not fit a small worker.
BATCH_ROWS = 500

# A side of a join is broadcast only up to this many rows (counted first);
# beyond it the join shuffles and AQE splits its skewed keys.
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder name below the shared folder of the session.

    ``spark.checkpoint.dir`` names that folder on a cluster.  Only a local
    master, where all tasks see one disk, may fall back to a scratch folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder in shared storage")
        root = getattr(sc, "_martwise_scratch", None) or tempfile.mkdtemp(prefix="martwise-")
        sc._martwise_scratch = root
    return f"{root}/martwise-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from the stored rows: nothing before is computed
    again, a lost executor loses nothing, and columns are pruned on reading.
    The folder is removed when the application ends, as results may be read
    until then; one that ends by losing its driver leaves it.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """``cut``, then let the driver's collector find the shuffles that nothing
    needs any more, so that Spark removes their files from the executors."""
    out = cut(df)
    df.sparkSession._jvm.System.gc()
    return out


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored ``df`` for broadcast if its counted rows are within ``limit``."""
    return F.broadcast(df) if df.count() <= limit else df


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session,
    and bound the rows that a worker holds at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_martwise_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(martwise.__file__))
    if os.path.isdir(top):
        path = os.path.join(tempfile.mkdtemp(prefix="martwise-ship-"), f"martwise_{uuid.uuid4().hex[:8]}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("martwise", os.path.relpath(full, top)))
        sc.addPyFile(path)
    sc._martwise_shipped = True


def word_count(text: Column) -> Column:
    """Words of ``text`` (null: 0), without making an array of them."""
    one = F.regexp_replace(text, r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.length(one).cast("long")).otherwise(F.lit(0).cast("long"))


def held_out(doc_id: Column) -> Column:
    """Rows never used for training: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


__all__ = ["SPACE", "WORD", "BROADCAST_ROWS", "read", "shared_dir", "cut", "stage", "small", "ship",
           "word_count", "held_out"]
