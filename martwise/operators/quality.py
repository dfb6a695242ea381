"""Data-quality checks DQ1-DQ5 as DataFrames.

Checks never change the data (except DQ2's removal, which lives in the
builders via ``dedup.keep_first``); each returns a small report frame.  All
checks of one kind on one table run in a single aggregate pass.  The
report is a long table ``(table_name, check_name, column_name, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwise.functions.columns import as_of_literal, count_if
from martwise.operators.ranking import holds_middle, log_grid, median_from_counts, place_bands

DEFAULT_MIN_DATE = "2020-01-01"
# bands of one column whose exact values are read: two hold the middle ranks, two the limits of 3 sigma
MOST_EDGES = 4


def null_counts(df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """DQ1 / A8: (table_name, column_name, null_count, row_count, null_pct)."""
    cols = [c for c in columns if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [count_if(F.col(c).isNull()).alias(f"_n{i}")
                                                  for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
                    for i, c in enumerate(cols)])
    return (row.select(F.col("_rows"), F.explode(arr).alias("_e"))
               .select(F.lit(table_name).alias("table_name"), F.col("_e.column_name"),
                       F.col("_e.null_count"), F.col("_rows").alias("row_count"),
                       F.when(F.col("_rows") > 0, F.col("_e.null_count") / F.col("_rows") * 100.0)
                        .alias("null_pct")))


def duplicate_counts(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """DQ2 / A9: rows beyond the first per key (nulls compare equal)."""
    keys = [k for k in keys if k in df.columns]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(F.sum("_c").cast("bigint").alias("row_count"),
                       F.count(F.lit(1)).alias("distinct_keys")) \
                  .select(F.lit(table_name).alias("table_name"),
                          F.lit(",".join(keys)).alias("key_columns"),
                          F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
                          "distinct_keys",
                          (F.coalesce("row_count", F.lit(0).cast("bigint")) - F.col("distinct_keys"))
                          .alias("duplicate_count"))


def blank_id_counts(df: DataFrame, id_col: str, table_name: str) -> DataFrame:
    """Q22: rows whose natural id is null or blank (never deduplicated, so
    reported instead): (table_name, column_name, blank_count, row_count)."""
    blank = F.col(id_col).isNull() | (F.trim(F.col(id_col).cast("string")) == "")
    return df.agg(F.count_if(blank).alias("blank_count"), F.count(F.lit(1)).alias("row_count")) \
             .select(F.lit(table_name).alias("table_name"), F.lit(id_col).alias("column_name"),
                     "blank_count", "row_count")


def date_range(df: DataFrame, column: str, table_name: str, min_date: str = DEFAULT_MIN_DATE,
               max_date: str | None = None, as_of=None) -> DataFrame:
    """DQ3 / A10: min, max, rows outside [min_date, max_date], rows after as_of.
    The default max is the day after as_of, at midnight."""
    now = as_of_literal(as_of)
    lo = F.lit(min_date).cast("timestamp_ntz")
    hi = (F.lit(max_date).cast("timestamp_ntz") if max_date
          else F.date_add(F.to_date(now), 1).cast("timestamp_ntz"))
    d = F.col(column).cast("timestamp_ntz")
    return df.agg(F.min(d).alias("min_value"), F.max(d).alias("max_value"),
                  count_if((d < lo) | (d > hi)).alias("out_of_range_count"),
                  count_if(d > now).alias("future_count")) \
             .select(F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"),
                     "min_value", "max_value", "out_of_range_count", "future_count")


def amount_stats(df: DataFrame, columns: Sequence[str], table_name: str,
                 allow_negative: bool = False) -> DataFrame:
    """DQ4 / A7 + A11 for one table: see ``amount_stats_many``."""
    return amount_stats_many([(df, columns, table_name, allow_negative)])


def amount_stats_many(specs: Sequence[tuple[DataFrame, Sequence[str], str, bool]]) -> DataFrame:
    """DQ4 / A7 + A11: mean, exact median, sample std, negatives, > 3 sigma
    for every (table, amount column) in ``specs``, in one plan.

    A table's amounts go through one exchange, which Spark reuses, so a table
    is built once, and are read from it twice as long (spec, value) rows.  The
    first read sums up bands of the log grid, combined map-side into a table
    bounded by the grid whatever the number of distinct values: count, mean,
    squared deviations, negatives, least and greatest value.  They give all
    but the median and the outliers, and say which bands hold the middle
    ranks and which lie on both sides of 3 sigma.  The second read takes the
    exact values of these few bands, at most ``MOST_EDGES`` per (table, column).
    The exchange is only reused where every reader asks for the same rows and
    columns: no reader may add a filter that Spark would push below it, and
    the bands have one reader, whose rows carry the statistics on.
    Mean and std are rounded to 4 and 2 places, beyond the noise that the order
    of summation leaves.  Std 0 or a single value has no outliers.
    """
    longs, labels = [], []
    for df, columns, table_name, allow_negative in specs:
        cols = [c for c in columns if c in df.columns]
        ids = [str(len(labels) + i) for i in range(len(cols))]  # short keys travel instead of the names
        labels += [F.struct(F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"),
                            F.lit(allow_negative).alias("allow_negative")) for c in cols]
        amounts = df.select(*[F.col(c).cast("double").alias(i) for c, i in zip(cols, ids, strict=True)])
        # rebalanced by value: the partitions of frequent values are split
        longs.append(amounts.hint("rebalance", *[F.col(i) for i in ids]).unpivot([], ids, "_spec", "x"))
    long = longs[0]
    for lf in longs[1:]:
        long = long.unionByName(lf)
    x = F.col("x")
    long = long.filter(x.isNotNull())
    bands = long.groupBy("_spec", log_grid(x).alias("_g")).agg(
        F.count(F.lit(1)).alias("_bc"), F.sum(x).alias("_sum"), F.var_pop(x).alias("_var"),
        F.min(x).alias("_lo"), F.max(x).alias("_hi"), count_if(x < 0).alias("_neg"))
    every = Window.partitionBy("_spec").orderBy("_g").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    off = F.col("_sum") / F.col("_bc") - F.col("_mean")
    stats = (place_bands(bands, ["_spec"])
             .withColumns({"_mean": F.sum("_sum").over(every) / F.col("_n"), "neg": F.sum("_neg").over(every)})
             .withColumn("_m2", F.sum((F.col("_var") + off * off) * F.col("_bc")).over(every))
             .withColumn("_std", F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1)))))
    # the distance from the mean falls up to it and rises from it, so the ends of a band tell about all of it
    far = lambda v: F.coalesce((F.col("_std") > 0) & (F.abs(v - F.col("_mean")) > 3 * F.col("_std")), F.lit(False))
    lo, hi = F.col("_lo"), F.col("_hi")
    all_far = (far(lo) & (lo > F.col("_mean"))) | (far(hi) & (hi < F.col("_mean")))
    edges = (stats.withColumn("_far", F.sum(F.when(all_far, F.col("_bc")).otherwise(0)).over(every))
             .withColumn("_mixed", ~all_far & (far(lo) | far(hi))).filter(holds_middle() | F.col("_mixed")))
    per = ["_spec", "_n", "_mean", "neg", "_std", "_far"]
    edges = edges.groupBy(*per).agg(F.collect_list(F.struct("_lo", "_hi", "_g", "_boff", "_mixed")).alias("_edges"))
    edges = edges.select("*", *[F.get("_edges", F.lit(i))[end].alias(f"{end}{i}") for i in range(MOST_EDGES) for end in ("_lo", "_hi")])
    # bands do not overlap: a value between the ends of one is of that band
    near = F.lit(False)
    for i in range(MOST_EDGES):
        near = near | x.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
    cells = (long.join(F.broadcast(edges), "_spec").filter(near).withColumn("_e", F.explode("_edges"))
             .filter(x.between(F.col("_e._lo"), F.col("_e._hi")))
             .groupBy(*per, F.col("_e._g").alias("_g"), F.col("_e._boff").alias("_boff"), F.col("_e._mixed").alias("_mixed"), "x")
             .agg(F.count(F.lit(1)).alias("c")))
    whole = cells.groupBy(*per).agg(F.sum(F.when(F.col("_mixed") & far(x), F.col("c")).otherwise(0)).alias("_beyond"))
    return (whole.join(median_from_counts(cells, "x", "c", ["_spec"], placed=True), "_spec", "left")
                 .withColumn("_of", F.array(*labels)[F.col("_spec").cast("int")])
                 .select("_of.table_name", "_of.column_name", F.col("_n").alias("value_count"),
                         F.round("_mean", 4).alias("mean"), "median", F.round("_std", 2).alias("std"),
                         F.when(~F.col("_of.allow_negative"), F.col("neg")).alias("negative_count"),
                         (F.col("_far") + F.col("_beyond")).alias("outlier_count")))


def table_profile(df: DataFrame, table_name: str, null_columns: Sequence[str] = (),
                  date_column: str | None = None, as_of=None, min_date: str = DEFAULT_MIN_DATE,
                  blank_id_column: str | None = None) -> DataFrame:
    """DQ1 + DQ3 + the Q22 blank-id count of one table in a single aggregate
    pass, already in the long report form (table_name, check_name,
    column_name, value): one scan per table instead of one per check."""
    aggs, names = [], []
    for c in [c for c in null_columns if c in df.columns]:
        aggs.append(F.count_if(F.col(c).isNull()).cast("double"))
        names.append(("nulls", c))
    if date_column and date_column in df.columns:
        now = as_of_literal(as_of)
        d = F.col(date_column).cast("timestamp_ntz")
        hi = F.date_add(F.to_date(now), 1).cast("timestamp_ntz")
        aggs.append(F.count_if((d < F.lit(min_date).cast("timestamp_ntz")) | (d > hi)).cast("double"))
        names.append(("out_of_range_count", date_column))
        aggs.append(F.count_if(d > now).cast("double"))
        names.append(("future_count", date_column))
    if blank_id_column and blank_id_column in df.columns:
        b = F.col(blank_id_column)
        aggs.append(F.count_if(b.isNull() | (F.trim(b.cast("string")) == "")).cast("double"))
        names.append(("blank_ids", blank_id_column))
    row = df.agg(*[a.alias(f"_m{i}") for i, a in enumerate(aggs)])
    arr = F.array(*[F.struct(F.lit(chk).alias("check_name"), F.lit(col).alias("column_name"),
                             F.col(f"_m{i}").alias("value")) for i, (chk, col) in enumerate(names)])
    return row.select(F.explode(arr).alias("_e")).select(F.lit(table_name).alias("table_name"), "_e.check_name",
                                                         "_e.column_name", "_e.value")


def quality_report(nulls: Sequence[DataFrame] = (), dups: Sequence[DataFrame] = (),
                   ranges: Sequence[DataFrame] = (), amounts: Sequence[DataFrame] = (),
                   blanks: Sequence[DataFrame] = (), profiles: Sequence[DataFrame] = ()) -> DataFrame:
    """DQ5: all checks as one long table (table_name, check_name, column_name, value).
    ``profiles`` are ``table_profile`` frames, already in that form."""
    parts = list(profiles)
    for d in blanks:
        parts.append(d.select("table_name", F.lit("blank_ids").alias("check_name"), "column_name",
                              F.col("blank_count").cast("double").alias("value")))
    for d in nulls:
        parts.append(d.select("table_name", F.lit("nulls").alias("check_name"), "column_name",
                              F.col("null_count").cast("double").alias("value")))
    for d in dups:
        parts.append(d.select("table_name", F.lit("duplicates").alias("check_name"),
                              F.col("key_columns").alias("column_name"),
                              F.col("duplicate_count").cast("double").alias("value")))
    for d in ranges:
        parts.append(_unpivot_cols(d, ["out_of_range_count", "future_count"]))
    for d in amounts:
        parts.append(_unpivot_cols(d, ["mean", "median", "std", "negative_count", "outlier_count"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _unpivot_cols(d: DataFrame, measures: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(m).alias("check_name"), F.col(m).cast("double").alias("value"))
                    for m in measures])
    return d.select("table_name", "column_name", F.explode(arr).alias("_e")) \
            .select("table_name", "_e.check_name", "column_name", "_e.value")
