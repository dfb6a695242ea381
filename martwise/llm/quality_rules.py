"""Quality rules judged per host.

Every document gets plain text statistics and rule flags.  The flags are
summed per host, each rule's failure rate is shrunk towards all hosts by a
beta prior fitted to the hosts (method of moments), and a host whose shrunk
rate is above the limit beyond doubt (mean less ``doubt`` posterior standard
deviations) is rejected.  The verdicts are joined back to the documents.

Defined cases: a null host is a host of its own.  A null or empty text has
no words and fails.  The prior counts as at least one and at most all documents;
with one host, or hosts that differ no more than sampling makes them, as all.  An empty table gives an
empty result.  Columns named like a result column are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwise.llm.common import WORD, small

MIN_WORDS = 50
REPEAT_SHARE = 50  # per cent of the words
SYMBOL_SHARE = 20  # symbols per hundred words
DUP_LINES = 3
MAX_RATE = 0.5
DOUBT = 2.0

STATS = T.StructType([T.StructField(n, T.LongType()) for n in
                      ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
RULES = ("base_failed", "symbols_failed", "lines_failed")

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    place: dict[str, int] = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    base = len(place)
    if base >= 2_000_000:  # three ids no longer fit into 63 bits: number the pairs first
        pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * base + ids[2:]
    else:
        windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)[1:]
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)),
            repeated_words(words))


@F.pandas_udf(STATS)
def _stats(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in text], columns=STATS.names)


def score_documents(docs: DataFrame) -> DataFrame:
    """``docs`` plus the statistics and a flag per rule (true: failed)."""
    keep = [c for c in docs.columns if c not in (*STATS.names, *RULES, "__s")]
    out = docs.select(*keep, _stats(F.col("text")).alias("__s")).select(*keep, "__s.*")
    return (out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words")))
            .withColumn("symbols_failed", 100 * F.col("n_symbols") > SYMBOL_SHARE * F.col("n_words"))
            .withColumn("lines_failed", F.col("n_dup_lines") > DUP_LINES))


def host_verdicts(scored: DataFrame, host: str = "source", max_rate: float = MAX_RATE,
                  doubt: float = DOUBT) -> DataFrame:
    """One row per host: its documents, the shrunk rate of each rule, and the verdict.

    Documents are summed per host before any shuffle; the prior needs sums
    over hosts only.
    """
    per = scored.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    moments = [F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("hosts"),
               F.sum(1.0 / F.col("n")).alias("inverse_n")]
    for r in RULES:
        moments += [F.sum(r).alias(f"{r}_sum"), F.avg(F.col(r) / F.col("n")).alias(f"{r}_mean"),
                    F.coalesce(F.var_samp(F.col(r) / F.col("n")), F.lit(0.0)).alias(f"{r}_var")]
    out = per.crossJoin(F.broadcast(per.agg(*moments)))  # one row of moments
    bad = F.lit(False)
    for r in RULES:
        pooled = F.col(f"{r}_sum") / F.col("all_n")
        spread = pooled * (1 - pooled)
        # variance between hosts = variance of the rates less what sampling adds
        between = F.col(f"{r}_var") - spread * F.col("inverse_n") / F.col("hosts")
        # hosts that differ no more than sampling makes them are all alike: the strongest prior, all documents
        strength = (F.when(between <= 0, F.col("all_n"))
                    .otherwise(F.greatest(F.lit(1.0), F.least(spread / between - 1, F.col("all_n").cast("double")))))
        a = F.col(r) + strength * pooled
        n = F.col("n") + strength
        rate = a / n
        sd = F.sqrt(rate * (1 - rate) / (n + 1))
        out = out.withColumn(f"{r}_rate", rate)
        bad = bad | (rate - doubt * sd > max_rate)
    return out.select("host", "n", *[f"{r}_rate" for r in RULES], bad.alias("host_rejected"))


def with_verdicts(scored: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """``scored`` plus ``kept``: no base failure and a host that is not rejected."""
    hosts = small(verdicts.select(F.col("host").alias("__host"), F.col("host_rejected").alias("__rejected")))
    base = scored.drop("kept") if "kept" in scored.columns else scored
    return (base.join(hosts, F.col(host).eqNullSafe(F.col("__host")))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("__rejected"))
            .drop("__host", "__rejected"))
