"""A space-filling order of several columns (K1 clustering).

Sorting field by field leaves the last fields scattered over a file.  Here
each field is turned into a rank on 2^BITS quantiles of its values, and the
bits of the ranks are interleaved: rows that lie close in the order are close
in every field, so the minima and maxima of row groups are narrow in all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
Z = "_z"


def _number(df: DataFrame, name: str) -> Column:
    """An order-preserving number of a column; of texts, of their first six bytes."""
    kind = df.schema[name].dataType.typeName()
    c = F.col(name)
    if kind in ("string", "varchar", "char"):
        return F.conv(F.hex(F.rpad(F.substring(c.cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """The inner quantiles of each column, from mergeable summaries in one pass: at most 2^bits - 1 numbers a column."""
    points = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(_number(df, c), points, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(columns)}


def z_value(df: DataFrame, bounds: dict[str, list[float]], bits: int = BITS) -> Column:
    """The interleaved ranks; a null has rank 0."""
    out = F.lit(0).cast("bigint")
    for k, (name, own) in enumerate(bounds.items()):
        number = _number(df, name)
        rank = F.size(F.filter(F.array(*[F.lit(float(b)) for b in own]), lambda b: b < number)) if own else F.lit(0)
        rank = F.when(number.isNull(), F.lit(0)).otherwise(rank)
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("bigint")
            out = out.bitwiseOR(F.shiftleft(bit, b * len(bounds) + k))
    return out


def with_z(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` plus the order in column ``_z``; reads ``df`` once more for the quantiles."""
    columns = list(columns)[:62 // bits]
    return df.withColumn(Z, z_value(df, quantile_bounds(df, columns, bits), bits))
