"""Keep-first deduplication (D1, D2, DQ2 removal).

``dropDuplicates`` keeps an arbitrary row, so "first" needs an explicit
sequence.  The winner per key is ``min(struct(sequence..., row))``: a plain
aggregate, so Spark combines map-side before the shuffle and a key that
holds a third of all rows is reduced in every map task instead of landing
whole in one reducer.  The full row as the last tie-break makes the result
deterministic even when the sequence ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwise.functions.columns import has_real_id


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = (),
               columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys`` (nulls compare equal), the first by ``order_by``.

    ``columns`` (default: all) are the columns kept; only they travel
    through the shuffle, since the aggregate cannot be column-pruned."""
    cols = list(columns) if columns is not None else df.columns
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      F.struct(*[F.col(c) for c in cols]).alias("_row"))
    return (df.groupBy(*keys)
              .agg(F.min(packed).alias("_first"))
              .select(*[F.col(f"_first._row.{c}").alias(c) for c in cols]))


def keep_first_with_id(df: DataFrame, keys: Sequence[str], id_col: str,
                       order_by: Sequence[Column | str] = (),
                       columns: Sequence[str] | None = None) -> DataFrame:
    """Q22 fix: only rows with a real (non-blank) id are deduplicated; rows
    without one are all kept (and counted by the quality checks).

    One aggregate, one scan: a row without a real id gets its sequence, its
    columns and its input partition as an extra grouping value, so it shares
    a group only with equal rows; these are counted and written out as often
    again.  Which equal rows share a group does not matter to the result, so
    a task that is run again gives the same; a row with many copies is
    counted per partition and does not land in one task."""
    real = F.coalesce(has_real_id(id_col), F.lit(False))
    solo, copies = "_solo", "_copies"
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    own = F.struct(F.spark_partition_id().alias("_part"), *[o.alias(f"_o{i}") for i, o in enumerate(order)],
                   *[F.col(c).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    staged = df.withColumn(solo, F.when(~real, own))
    cols = list(columns) if columns is not None else df.columns
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      F.struct(*[F.col(c) for c in cols]).alias("_row"))
    firsts = (staged.groupBy(*keys, solo)
              .agg(F.min(packed).alias("_first"), F.count(F.lit(1)).alias(copies)))
    times = F.when(F.col(solo).isNull(), F.lit(1).cast("bigint")).otherwise(F.col(copies))
    # in two steps, so that no array is longer than the square root of the copies, and a step at most
    step = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.sqrt(times.cast("double"))).cast("bigint"))
    parts = firsts.select("_first", times.alias("_times"), step.alias("_step")).select(
        "_first", "_times", "_step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_times") - 1, F.col("_step"))).alias("_from"))
    return (parts.select("_first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("_step", F.col("_times") - F.col("_from")))))
            .select(*[F.col(f"_first._row.{c}").alias(c) for c in cols]))
