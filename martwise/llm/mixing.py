"""Mixing sources to target weights (native: DataFrame functions only).

Sizes are summed per source, targets follow from the sources' weights, and
a document is emitted ``floor(rate)`` times plus once more with probability
``rate - floor(rate)``, where ``rate`` is its source's target over its size.
The draw is a hash of a seed, the document's id and its text, so that a
re-run, or a task run again after a lost executor, emits the same rows.

Defined cases: a null source is a source of its own, last in order.  A null
or empty text has size 0.  A source whose documents all have size 0 gets
target 0 and emits nothing.  Rows that agree in id and text share one draw.
An empty table gives an empty result.  Columns named like a result column
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwise.llm.common import cut, small, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"


def sums_before(per: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``per`` with the sums over the rows before each, in a total ``order``.

    Rows are cut into ranges of the order; a range sums up its own, and adds
    the totals of the ranges before it, a row a range.  No task holds all rows.
    """
    dealt = cut(per.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    totals = dealt.groupBy("__range").agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.select("__range", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumns({n: F.coalesce(F.sum(e).over(inside), F.lit(0)) for n, e in sums.items()})
    return own.join(F.broadcast(offsets), "__range").select(
        *per.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Targets from (source, size): one row per source.

    The sources, ordered by code point with null last, take the weights in
    turn.  A target stops at ``cap`` times the source's size; what is over
    goes to the others by weight.  Sorted by size over weight, the stopped
    sources come first, so running sums give the final level in one pass.
    Sources may be as many as hosts: they are summed in ranges, and the
    driver sees totals only.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = sums_before(per, [F.col("source").asc_nulls_last()], {"__place": F.lit(1)})
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.col("__place") % len(weights) + 1).cast("int"))).drop("__place")
    per = cut(sums_before(per, [F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()],
                          {"size_before": F.col("source_size"), "weight_before": F.col("weight")}))
    total_size, total_weight = per.agg(F.sum("source_size"), F.sum("weight")).first()  # one row
    total = F.lit(float(total_size or 0) * share)
    level = (total - cap * F.col("size_before").cast("double")) / (F.lit(total_weight or 0.0) - F.col("weight_before"))
    full = cap * F.col("source_size").cast("double")
    per = per.withColumn("stopped", full <= level * F.col("weight"))
    stopped_size, stopped_weight = per.filter("stopped").agg(F.sum("source_size"), F.sum("weight")).first()
    open_weight = float(total_weight or 0.0) - float(stopped_weight or 0.0)
    rest = float(total_size or 0) * share - cap * float(stopped_size or 0)
    final = F.lit(rest / open_weight if open_weight > 0 else None).cast("double")
    target = F.when(F.col("stopped"), full).otherwise(final * F.col("weight"))
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return per.select("source", "source_size", "weight", "target", rate.alias("rate"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1): 52 bits of the md5 of seed, id and the text's md5."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")),
                      F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(2 ** 52)


def copies(rate: Column, u: Column) -> Column:
    whole = F.floor(rate)
    return whole + F.when(u < rate - whole, F.lit(1)).otherwise(F.lit(0))


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED,
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` plus size, source_size, target, rate and copies.

    Text is scanned once: sizes and draws are stored beside the kept
    columns, and the rates (one row per source, counted) are joined on.
    """
    keep = keep if keep is not None else docs.columns
    new = ("size", "source_size", "target", "rate", "copies", "__u", "__source")
    sized = cut(docs.select(*[F.col(c) for c in keep if c not in new], F.col("source").alias("__source"),
                            word_count(F.col("text")).alias("size"),
                            draw(F.col("doc_id"), F.col("text"), seed).alias("__u")))
    targets = cut(source_targets(sized.select(F.col("__source").alias("source"), "size"), weights, share, cap))
    rates = small(targets.select(F.col("source").alias("__s"), "source_size", "target", "rate"))
    return (sized.join(rates, F.col("__source").eqNullSafe(F.col("__s")))
            .withColumn("copies", copies(F.col("rate"), F.col("__u")))
            .drop("__s", "__source", "__u"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as its copies say."""
    planned = plan_mix(docs, weights, share, cap, seed)
    return (planned.filter(F.col("copies") > 0)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
            .select(*[F.col(c) for c in docs.columns]))
