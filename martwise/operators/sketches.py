"""Daily sketches that merge: quantiles (A7, A11) and distinct counts (M3, M16) of any span of days
without reading the rows again.

A sketch table has one row per day and measure, a few kilobytes each however
many rows the day has, so any range of days, a month or the year to date is
a merge of small rows.  Sketches are built map-side combined in one pass.  The
exact measures stay beside them.

* KLL for quantiles.  With k = 1600 the rank of an answer is off by less than
  ``RANK_ERROR`` of the values, with 99 % confidence, merged or not.
* Theta for distinct counts.  With 2^16 entries counts are exact up to 65,536
  distinct values and then off by ``DISTINCT_ERROR`` (two deviations); sketches
  of two steps intersect, which gives how many went through both.

Defined cases: null values are in no sketch; a null day has a row of its own
and lies in no range.  A range without rows gives no rows (quantiles) or 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K = 1600
RANK_ERROR = 0.005
THETA_LG = 16
DISTINCT_ERROR = 2 / 2 ** (THETA_LG / 2)


def daily_quantiles(df: DataFrame, date_column: str, columns: Sequence[str], k: int = KLL_K) -> DataFrame:
    """(day, column_name, sketch): a KLL sketch of each amount per day."""
    values = df.select(F.to_date(date_column).alias("day"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])).alias("e"))
    return (values.select("day", "e.*").filter(F.col("x").isNotNull()).groupBy("day", "column_name")
            .agg(F.kll_sketch_agg_double("x", k).alias("sketch")))


def _between(df: DataFrame, day_from, day_to) -> DataFrame:
    if day_from is not None:
        df = df.filter(F.col("day") >= F.lit(str(day_from)).cast("date"))
    if day_to is not None:
        df = df.filter(F.col("day") <= F.lit(str(day_to)).cast("date"))
    return df


def quantiles(daily: DataFrame, ranks: Sequence[float] = (0.5,), day_from=None, day_to=None, by: Sequence[str] = (),
              k: int = KLL_K) -> DataFrame:
    """(by..., column_name, n, quantiles) of a range of days from the merged sketches."""
    merged = _between(daily, day_from, day_to).groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch", k).alias("s"))
    return merged.select(*by, "column_name", F.kll_sketch_get_n_double("s").alias("n"),
                         F.array(*[F.kll_sketch_get_quantile_double("s", F.lit(r)) for r in ranks]).alias("quantiles"))


def daily_distinct(df: DataFrame, date_column: str, key: str, by: Sequence[str] = (), lg: int = THETA_LG) -> DataFrame:
    """(day, by..., sketch): a theta sketch of the keys per day (and step)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(F.to_date(date_column).alias("day"), *by)
            .agg(F.theta_sketch_agg(key, lg).alias("sketch")))


def distinct(daily: DataFrame, day_from=None, day_to=None, by: Sequence[str] = (), lg: int = THETA_LG) -> DataFrame:
    """(by..., distinct_count) of a range of days from the united sketches."""
    united = _between(daily, day_from, day_to).groupBy(*by).agg(F.theta_union_agg("sketch", lg).alias("s"))
    return united.select(*by, F.coalesce(F.theta_sketch_estimate("s"), F.lit(0)).cast("long").alias("distinct_count"))


def running_distinct(daily: DataFrame, lg: int = THETA_LG) -> DataFrame:
    """(month, distinct_count, distinct_ytd): M3 by month and M16's year to date.

    A month's days unite first; the year to date then unites at most twelve
    sketches a month.
    """
    months = (daily.filter(F.col("day").isNotNull()).groupBy(F.trunc("day", "month").alias("month"))
              .agg(F.theta_union_agg("sketch", lg).alias("s")))
    earlier = months.select(F.col("month").alias("m"), F.col("s").alias("t"))
    pairs = months.select("month", F.year("month").alias("y")).join(
        earlier.withColumn("y", F.year("m")), "y").filter(F.col("m") <= F.col("month"))
    ytd = pairs.groupBy("month").agg(F.theta_sketch_estimate(F.theta_union_agg("t", lg)).cast("long").alias("distinct_ytd"))
    return months.select("month", F.theta_sketch_estimate("s").cast("long").alias("distinct_count")).join(ytd, "month")


def funnel(daily_steps: DataFrame, steps: Sequence[str], step_column: str = "event_type", day_from=None, day_to=None,
           lg: int = THETA_LG) -> DataFrame:
    """(step_order, step, reached, passed): keys that have the step, and those that have it and all before it."""
    of = _between(daily_steps, day_from, day_to)
    union = of.agg(*[F.theta_union_agg(F.when(F.col(step_column) == s, F.col("sketch")), lg).alias(f"s{i}")
                     for i, s in enumerate(steps)])
    rows, both = [], None
    for i, s in enumerate(steps):
        both = F.col(f"s{i}") if both is None else F.theta_intersection(both, F.col(f"s{i}"))
        rows.append(F.struct(F.lit(i + 1).alias("step_order"), F.lit(s).alias("step"),
                             F.coalesce(F.theta_sketch_estimate(F.col(f"s{i}")), F.lit(0)).cast("long").alias("reached"),
                             F.coalesce(F.theta_sketch_estimate(both), F.lit(0)).cast("long").alias("passed")))
    return union.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
