"""Raw gzip JSON sources.

A file holds one top-level JSON array (many records) or one object (one
record); ``multiLine`` reads both.  Gzip is not splittable, so a file is
read by one task: many files give many tasks (S2), and one huge file
is read in chunks (``json_chunks``, S3) and should be landed once
(``land_bronze``) so everything downstream is parallel (hard point H1).  Paths are any Hadoop path (file:, s3a:, gs:,
abfs:) - Spark's filesystem layer does the listing and reading.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwise import schemas

# File layout of the exports (relative to the bucket root);
# a star stands for the number of a batch file, from 0.
SOURCE_FILES = {
    "shopify_orders": "shopify/orders_batch_*.json.gz",
    "sapo_orders": "sapo/transactions.json.gz",
    "customers": "shared/customers/customers_batch_*.json.gz",
    "products": "shared/products.json.gz",
    "locations": "shared/sapo_locations.json.gz",
    "online_orders": "online_orders/online_orders.json.gz",
    "paypal": "paypal/transactions.json.gz",
    "momo": "momo/transactions.json.gz",
    "zalopay": "zalopay/transactions.json.gz",
    "mercury_accounts": "mercury/accounts.json.gz",
    "mercury_transactions": "mercury/transactions.json.gz",
    "cart_events": "cart_tracking/cart_events.json.gz",
}
SOURCE_SCHEMAS = {
    "shopify_orders": schemas.RAW_ORDER, "sapo_orders": schemas.RAW_ORDER, "online_orders": schemas.RAW_ORDER,
    "customers": schemas.RAW_CUSTOMER, "products": schemas.RAW_PRODUCT, "locations": schemas.RAW_LOCATION,
    "paypal": schemas.RAW_PAYPAL, "momo": schemas.RAW_MOMO, "zalopay": schemas.RAW_ZALOPAY,
    "mercury_accounts": schemas.RAW_MERCURY_ACCOUNT, "mercury_transactions": schemas.RAW_MERCURY_TXN,
    "cart_events": schemas.RAW_CART_EVENT,
}
# Sources in one large file, or with places in their keys (W7): read record by
# record in bounded memory.
CHUNKED_SOURCES = ("cart_events", "mercury_transactions")
# Column holding the position of a record: (file name, position in file)
# is the "first" order for deduplication (hard point H3).
SEQ = "_seq"
# Column naming the source of a record in a union of several sources.
TAG = "_source"


def _reader(spark: SparkSession, schema: T.StructType | None):
    # a file that does not parse fails the load instead of giving null rows
    r = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return r.schema(schema) if schema is not None else r


def read_json_gzip(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType | None = None) -> DataFrame:
    """S1 (one path) / S2 (a list of paths): records plus a sequence column
    (file, ordinal of the record) for keep-first dedup.

    ``line_items`` is read as an array of JSON texts and each element parsed
    on its own, so an element that is not an object becomes null (and is
    dropped by the item builder, FL5) without taking the others with it."""
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None or "line_items" not in schema.fieldNames():
        return with_file_sequence(_reader(spark, schema).json(paths))
    df = with_file_sequence(_reader(spark, _item_texts(schema)).json(paths))
    return df.withColumn("line_items", parse_items(F.col("line_items"), schema["line_items"].dataType.elementType))


def _item_texts(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.ArrayType(T.StringType())) if f.name == "line_items" else f
                         for f in schema.fields])


def parse_records(text: Column, schema: T.StructType) -> Column:
    """The JSON text of a record as a struct of ``schema``, read as the file reader reads it."""
    if "line_items" not in schema.fieldNames():
        return F.from_json(text, schema, {"mode": "FAILFAST"})
    r = F.from_json(text, _item_texts(schema), {"mode": "FAILFAST"})
    return r.withField("line_items", parse_items(r["line_items"], schema["line_items"].dataType.elementType))


def parse_items(texts: Column, item: T.StructType) -> Column:
    """Each JSON text of an array as a struct; null where it is not an object."""
    return F.transform(texts, lambda t: F.when(F.ltrim(t).startswith("{"), F.from_json(t, item)))


def with_file_sequence(df: DataFrame) -> DataFrame:
    """Add ``_seq`` = struct(file, row ordinal).

    ``file`` starts with the batch number in the file's name (zero-padded, so
    batch 10 sorts after batch 2), followed by its path.  A gzip file is one
    split, so the ordinal increases within a file; it orders records but moves
    with the packing of files.  Places that go into keys are counted by
    ``json_chunks``."""
    return df.withColumn(SEQ, F.struct(file_key().alias("file"), ordinal().alias("pos")))


def file_key() -> Column:
    """The file of a record, in an order that follows batch numbers."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"_batch_(\d+)\.", 1)
    return F.concat(F.lpad(number, 9, "0"), F.lit(":"), F.col("_metadata.file_path"))


def ordinal() -> Column:
    """The position of a record in its read partition, without the partition number."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def source_paths(spark: SparkSession, root: str, name: str) -> list[str]:
    """The existing files of a source; numbered batch files in order.

    Every batch file there is belongs to the source.  A gap in the numbers
    is an error, never a silently smaller source; no file at all is an absent
    source (an empty list).  The listing holds file names only, as Spark's own
    listing of the read does."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{SOURCE_FILES[name]}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = sorted(f.getPath().toString() for f in found or ())
    if "*" not in SOURCE_FILES[name]:
        return paths
    numbered = sorted((int(m.group(1)), p) for p in paths if (m := re.search(r"_batch_(\d+)\.", p)))
    missing = sorted(set(range(len(numbered))) - {n for n, _ in numbered})
    if missing:
        raise FileNotFoundError(f"{name}: batch files {[n for n, _ in numbered]} have gaps at {missing[:10]}")
    return [p for _, p in numbered]


def read_source_if_present(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A named source, or None when none of its files exist."""
    paths = source_paths(spark, root, name)
    if not paths:
        return None
    if name == "mercury_accounts":
        from martwise.sources.json_chunks import read_accounts

        return read_accounts(spark, paths)
    if name in CHUNKED_SOURCES:
        from martwise.sources.json_chunks import read_json_chunked

        return read_json_chunked(spark, paths, SOURCE_SCHEMAS[name])
    return read_json_gzip(spark, paths, SOURCE_SCHEMAS[name])


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One named source under ``root`` with its explicit schema."""
    df = read_source_if_present(spark, root, name)
    if df is None:
        raise FileNotFoundError(f"{name}: no file {SOURCE_FILES[name]} under {root}")
    return df


def land_bronze(df: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """S3 / H1: write a raw source once as Parquet, spread over many files,
    and read it back: a single huge gzip file is parsed by one task once,
    then every later step is parallel.  By
    default the rows are rebalanced, so AQE cuts them into partitions of
    its advisory size whatever the file size was."""
    out = df.repartition(partitions) if partitions else df.hint("rebalance")
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from start to end inclusive (column ``full_date``).
    Dates are literals or Columns of a one-row frame's scope."""
    s = F.lit(str(start)).cast("date") if not hasattr(start, "_jc") else start.cast("date")
    e = F.lit(str(end)).cast("date") if not hasattr(end, "_jc") else end.cast("date")
    return spark.range(1).select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("full_date"))


SEQ_TYPE = T.StructType([T.StructField("file", T.StringType()), T.StructField("pos", T.LongType())])


def conform_raw(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw schema fields (missing ones as typed nulls, all cast to the raw
    types) plus the sequence and source-tag columns when present."""
    have = set(df.columns)
    cols = [(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]
    extra = [c for c in (SEQ, TAG) if c in have]
    return df.select(*cols, *extra)


def struct_of(fields: dict[str, Column], schema: T.StructType) -> Column:
    """Struct with exactly ``schema``'s fields; those not given are null."""
    return F.struct(*[(fields[f.name].cast(f.dataType) if f.name in fields
                       else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def tag_union(frames: dict[str, DataFrame | None], schema: T.StructType) -> DataFrame | None:
    """Union by name of several sources' raw records, each tagged
    with its source name in ``_source``; missing fields read as null."""
    parts = []
    for name, df in frames.items():
        if df is None:
            continue
        c = conform_raw(df, schema)
        if SEQ not in c.columns:
            c = c.withColumn(SEQ, F.lit(None).cast(SEQ_TYPE))
        parts.append(c.withColumn(TAG, F.lit(name)))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
