"""Exact ranks and quantile buckets without a single-partition sort (H2).

``row_number().over(Window.orderBy(x))`` plans ``Exchange SinglePartition``:
every row goes through one task.  And ``partitionBy(customer)`` puts a hot
customer's rows in one task.  Here a rank is built from counts instead:

1. Each row gets a *coarse* group ``g`` (monotone in the order value) and a
   *tie bucket* ``tb`` (monotone in the tie-break column).
2. ``h = count per (P, g, v, tb)``: a partial aggregate, combined map-side.
3. Offsets: a running sum of group sizes over ``(P, g)`` (a table whose size
   is set by the coarse grid, not the data), then inside each ``g`` over
   the ``h`` rows.  Only these small count tables see a window.
4. Rows join their ``(P, g, v, tb)`` offset and add a ``row_number`` inside
   that cell.  A cell holds one order value and one tie bucket, so a heavy
   key (one customer, one amount) is spread over many cells and tasks.

The result equals ``row_number() OVER (PARTITION BY P ORDER BY v, t)`` with
nulls first, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Grid resolution of the default coarse group: 2048 groups per doubling of
# |v|, so the group table is bounded (< 2 * 64 * 2048 rows, a few MB)
# whatever the data, while a band of nearby values stays narrow.
LOG_STEPS_PER_OCTAVE = 2048
# Leading characters that form the tie bucket of a text tie-break column.
# Meant for hashed keys, whose first characters are evenly spread; text ids
# with a common prefix need a ``tie_bucket`` of their own.
TEXT_BUCKET_CHARS = 3


def log_grid(v: Column) -> Column:
    """Monotone coarse group of a numeric value on a signed log grid."""
    mag = F.floor(F.log2(F.abs(v.cast("double")) + F.lit(1.0)) * F.lit(LOG_STEPS_PER_OCTAVE))
    return (F.signum(v.cast("double")) * mag).cast("bigint")


def text_bucket(t: Column) -> Column:
    return F.left(t.cast("string"), F.lit(TEXT_BUCKET_CHARS))


def _suffixed(df: DataFrame, cols: Sequence[str], suffix: str) -> DataFrame:
    """Rename ``cols`` so a join with a frame derived from the same input
    has no ambiguous columns."""
    return df.withColumnsRenamed({c: c + suffix for c in cols})


def _null_safe_on(cols: Sequence[str], suffix: str) -> Column:
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(c + suffix))
        cond = e if cond is None else cond & e
    return cond


def _cell_offsets(df: DataFrame, part: Sequence[str], counted: bool = False) -> DataFrame:
    """Offsets per (part, _g, _v, _tb) cell: ``_start`` = rows before the
    cell in (part) order, and ``_n`` = rows in the partition.  With
    ``counted``, ``df`` already holds one row per cell with its count ``_c``."""
    h = df if counted else df.groupBy(*part, "_g", "_v", "_tb").agg(F.count(F.lit(1)).alias("_c"))
    grp = h.groupBy(*part, "_g").agg(F.sum("_c").alias("_gc"))
    w_all = Window.partitionBy(*part) if part else Window.partitionBy()
    w_run = w_all.orderBy(F.col("_g").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    grp = grp.select(*part, "_g",
                     (F.sum("_gc").over(w_run) - F.col("_gc")).alias("_goff"),
                     F.sum("_gc").over(w_all.rowsBetween(Window.unboundedPreceding,
                                                         Window.unboundedFollowing)).alias("_n"))
    w_in = (Window.partitionBy(*part, "_g")
            .orderBy(F.col("_v").asc_nulls_first(), F.col("_tb").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, 0))
    h = h.select(*part, "_g", "_v", "_tb", "_c",
                 (F.sum("_c").over(w_in) - F.col("_c")).alias("_hoff"))
    gk = [*part, "_g"]
    cells = h.join(_suffixed(grp, gk, "_r"), on=_null_safe_on(gk, "_r"), how="inner") \
             .select(*part, "_g", "_v", "_tb", "_c", (F.col("_goff") + F.col("_hoff")).alias("_start"), "_n")
    return cells


def exact_rank(df: DataFrame, order_value: Column | str, tie: Column | str,
               partition_by: Sequence[str] = (), rank_col: str = "rank",
               count_col: str | None = None, coarse: Column | None = None,
               tie_bucket: Column | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based row number in (partition_by) ordered by
    (order_value, tie), nulls first; optionally ``count_col`` = partition size.

    ``order_value`` must be numeric (timestamps: pass their epoch micros);
    ``tie`` should be unique within the partition for a total order.
    """
    v = F.col(order_value) if isinstance(order_value, str) else order_value
    t = F.col(tie) if isinstance(tie, str) else tie
    part = list(partition_by)
    g = coarse if coarse is not None else log_grid(v)
    tb = tie_bucket if tie_bucket is not None else _default_tie_bucket(df, t)
    staged = df.withColumns({"_g": g, "_v": v, "_tb": tb, "_t": t})
    cells = _cell_offsets(staged, part)
    keys = [*part, "_g", "_v", "_tb"]
    cells = _suffixed(cells.select(*keys, "_start", "_n"), keys, "_r")
    joined = staged.join(cells, on=_null_safe_on(keys, "_r"), how="inner") \
                   .drop(*[k + "_r" for k in keys])
    w = Window.partitionBy(*keys).orderBy(F.col("_t").asc_nulls_first())
    out = joined.withColumn(rank_col, (F.col("_start") + F.row_number().over(w)).cast("bigint"))
    if count_col:
        out = out.withColumn(count_col, F.col("_n").cast("bigint"))
    return out.drop("_g", "_v", "_tb", "_t", "_start", "_n")


def _default_tie_bucket(df: DataFrame, t: Column) -> Column:
    """Numeric ties fall on the log grid: its size is fixed, so the cells of a
    heavy value stay few however sparse the ids are, and each holds a small
    share of them however dense."""
    dtype = df.select(t.alias("_x")).schema["_x"].dataType.typeName()
    if dtype in ("long", "integer", "short", "byte", "double", "float", "decimal"):
        return log_grid(t)
    return text_bucket(t)


def _inside(k: Column, start: str, size: str) -> Column:
    return (F.col(start) < k) & (k <= F.col(start) + F.col(size))


def _middle_ranks() -> tuple[Column, Column]:
    return F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1


def place_bands(bands: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """``bands``, one row per group and band ``_g`` with its rows ``_bc``, with
    the rows before the band ``_boff`` and the rows of the group ``_n``."""
    w = (Window.partitionBy(*group_by) if group_by else Window.partitionBy()).orderBy("_g")
    return bands.withColumns({
        "_boff": F.sum("_bc").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_bc"),
        "_n": F.sum("_bc").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})


def holds_middle() -> Column:
    """Whether a placed band holds one of the middle ranks."""
    lo, hi = _middle_ranks()
    return _inside(lo, "_boff", "_bc") | _inside(hi, "_boff", "_bc")


def median_from_counts(counts: DataFrame, value: str, count: str,
                       group_by: Sequence[str] = (), placed: bool = False) -> DataFrame:
    """Exact median per group from a value histogram (one row per distinct
    non-null value with its count): the mean of the values at ranks
    floor((n+1)/2) and floor(n/2)+1, as pandas and DuckDB compute it.

    Two levels, nothing collected: band counts on the log grid (a table
    bounded by the grid) locate the one or two bands holding the middle
    ranks; only the histogram rows of those bands are then ordered.  The
    located bands are at most two rows per group, so broadcasting them is
    bounded by the number of groups.  Their join is null-safe: a plain one
    would have Spark filter the bands for nulls below the histogram, which
    would then be built a second time.

    With ``placed`` the histogram rows carry ``_g``, ``_boff`` and ``_n`` of
    their band (``place_bands``) and may be those of a few bands alone, the
    ones that ``holds_middle`` among them."""
    part = list(group_by)
    c = counts.withColumnsRenamed({value: "_v", count: "_c"})
    if placed:
        sel = c.select(*part, "_v", "_c", "_g", "_boff", "_n")
    else:
        c = c.select(*part, "_v", "_c", log_grid(F.col("_v")).alias("_g"))
        bands = c.groupBy(*part, "_g").agg(F.sum("_c").alias("_bc"))
        hit = place_bands(bands, part).filter(holds_middle()).drop("_bc")
        keys = [*part, "_g"]
        sel = c.join(F.broadcast(_suffixed(hit, keys, "_r")), _null_safe_on(keys, "_r")).drop(*[k + "_r" for k in keys])
    w_in = Window.partitionBy(*part, "_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    sel = sel.withColumn("_start", F.col("_boff") + F.sum("_c").over(w_in) - F.col("_c"))
    lo, hi = _middle_ranks()
    picked = sel.select(*part,
                        F.when(_inside(lo, "_start", "_c"), F.col("_v").cast("double")).alias("_lo"),
                        F.when(_inside(hi, "_start", "_c"), F.col("_v").cast("double")).alias("_hi"))
    return picked.groupBy(*part).agg(((F.max("_lo") + F.max("_hi")) / F.lit(2.0)).alias("median"))


def qcut_bucket(rank: Column, n: Column, q: int = 5) -> Column:
    """Q6: bucket of a 1-based rank the way quantile cutting of ranks 1..n
    into ``q`` equal-width bins does it (right-closed, lowest included):
    ``greatest(1, ceil(q*(r-1)/(n-1)))`` in integer arithmetic; n = 1 gives 1.
    Not NTILE: sizes differ when n mod q is 2, 3 or 4."""
    num = F.lit(q) * (rank - 1) + (n - 2)
    return (F.when(n <= 1, F.lit(1))
             .otherwise(F.greatest(F.lit(1), F.floor(num / (n - 1)).cast("int")))
             .cast("int"))


def ntile_bucket(rank: Column, n: Column, q: int = 5) -> Column:
    """NTILE(q) from a rank: the first n mod q buckets get one extra row."""
    size = F.floor(n / q)
    rem = n - size * q
    big = rem * (size + 1)
    return (F.when(rank <= big, F.floor((rank - 1) / (size + 1)) + 1)
             .otherwise(rem + F.floor((rank - big - 1) / F.greatest(size, F.lit(1))) + 1)
             .cast("int"))
