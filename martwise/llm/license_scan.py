"""License scans: phrases, and an exact containment join against notices
(native: DataFrame functions only).

A block is a run of consecutive words of a text, line breaks or not: as many
as the notice has over ``THRESHOLD``, and ``INSERTED`` more.  A notice is found
in a run that holds ``THRESHOLD`` or more of the notice's distinct words, and
all words that tell it from a notice of another label which holds as many.  A
notice on one line and the same notice wrapped over several are judged alike,
and words scattered over a long sentence are none.

Runs are taken from stretches of words that overlap by the longest run, so
each run is whole in one; stretches with too few words of every notice are left
out before the join.  The join is exact: words are ordered by how many
stretches hold them, rarest first; a stretch and a notice that share enough
words share one among the first few of each (prefix filter), the stretch has
enough words (length filter), and enough words are left after the shared one in
both (positional filter).  Pairs that pass are verified run by run.  Only words
of the notices can count, so stretches are compared by those words; the notices
are a fixed, bounded list.

Defined cases: a null text is empty; a text without words has no places,
labels '' and score 0.  Repeated rows are each judged.  An empty table gives an
empty result.  Columns named like a result column are replaced.
"""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwise.llm.common import cut

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices of public licenses and the label of each.
NOTICES = {
    "apache-notice": ["licensed under the apache license version 2 0",
                      "you may not use this file except in compliance with the license",
                      "unless required by applicable law or agreed to in writing software distributed under the license "
                      "is distributed on an as is basis without warranties or conditions of any kind"],
    "bsd-notice": ["redistribution and use in source and binary forms with or without modification are permitted "
                   "provided that the following conditions are met"],
    "cc-by-nc-notice": ["licensed under cc by nc 4 0",
                        "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-notice": ["this work is licensed under a creative commons attribution 4 0 international license"],
    "gpl-notice": ["this work is licensed under the gnu general public license version 3",
                   "it under the terms of the gnu general public license as published by the free software foundation"],
    "mit-notice": ["released under the mit license",
                   "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                   "associated documentation files"],
    "mpl-notice": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}
THRESHOLD = 0.9
INSERTED = 6  # other words that may stand in a run besides

# The two letters outside ASCII whose lower case is or holds an ASCII letter.
_KELVIN, _DOTTED = "K", "İ"


def _words_only(text: Column) -> Column:
    """Lower-cased text with every run of other characters as a space; lines stay."""
    other = F.lit("é")
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), other), F.lit(_DOTTED), other)
    return F.regexp_replace(F.lower(plain), r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def scan_phrases(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """``docs`` plus n_words, n_base, first_word, last_word, the list base_found, and __lined."""
    new = ("n_words", "n_base", "first_word", "last_word", "base_found", "__lined", "__flat")
    out = docs.drop(*new).withColumn("__lined", _words_only(F.col("text")))
    out = out.withColumn("__flat", F.concat(F.lit(" "), F.trim(F.regexp_replace("__lined", r" *\n[ \n]*", " ")), F.lit(" ")))
    flat = F.col("__flat")
    out = out.withColumn("n_words", F.when(F.length(flat) <= 2, F.lit(0)).otherwise(_spaces(flat) - 1).cast("long"))
    counts, firsts, lasts, found = [], [], [], []
    for phrase, label in phrases.items():
        padded = f" {phrase} "
        has = flat.contains(padded)
        counts.append(F.when(has, F.regexp_count(flat, F.lit(f"(?<= )(?={phrase} )"))).otherwise(F.lit(0)))
        before = F.substring(flat, F.lit(1), F.locate(padded, flat))
        firsts.append(F.when(has, _spaces(before) - 1))
        back = F.reverse(flat)
        after = F.substring(back, F.lit(1), F.locate(padded[::-1], back))
        lasts.append(F.when(has, F.col("n_words") - (_spaces(after) - 1) - len(phrase.split())))
        found.append(F.when(has, F.lit(label)))
    low = firsts[0] if len(firsts) == 1 else F.least(*firsts)
    high = lasts[0] if len(lasts) == 1 else F.greatest(*lasts)
    return (out.withColumn("n_base", sum(counts[1:], counts[0]).cast("long"))
            .withColumn("first_word", low.cast("long")).withColumn("last_word", high.cast("long"))
            .withColumn("base_found", F.array_sort(F.array_distinct(F.array_compact(F.array(*found)))))
            .drop("__flat"))


def _run(text: str, threshold: float) -> int:
    """Words of a run that is compared with the notice ``text``."""
    return ceil(len(text.split()) / threshold - 1e-9) + INSERTED


def _telling(words: list[str], label: str, texts: list[tuple[str, list[str], int]], need: int) -> list[str]:
    """Words that a notice of another label lacks though it holds ``need`` of ``words``."""
    like = [ws for other, ws, _ in texts if other != label and len(set(ws) & set(words)) >= need]
    return [w for w in words if any(w not in ws for ws in like)]


def _may_hold(words: Column, notices: dict[str, list[str]], threshold: float) -> Column:
    """Whether ``words`` has enough words of any notice."""
    tests = [F.size(F.array_intersect(_literals(sorted(set(t.split()))), words)) >= ceil(threshold * len(set(t.split())) - 1e-9)
             for ts in notices.values() for t in ts]
    return reduce(or_, tests)


def _stretches(words: Column, run: int) -> Column:
    """``words`` in stretches of 2 ``run`` words, each ``run`` words after the last: every run is whole in one."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - run, F.lit(1)), F.lit(run))
    return F.transform(starts, lambda at: F.slice(words, at, F.lit(2 * run)))


def _literals(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def find_notices(blocks: DataFrame, notices: dict[str, list[str]] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """(row, block, label, containment) of every stretch with a run that holds a notice.

    ``blocks`` has row, block, words (the stretch's distinct words that belong
    to any notice) and stretch (its words in order).
    """
    spark = blocks.sparkSession
    held = {r["word"]: r["n"] for r in blocks.select(F.explode("words").alias("word")).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the notices' words
    texts = [(label, sorted(set(t.split())), _run(t, threshold)) for label, ts in notices.items() for t in ts]
    order = sorted({w for _, ws, _ in texts for w in ws}, key=lambda w: (held.get(w, 0), w))
    rows = []
    for number, (label, words, run) in enumerate(texts):
        words = sorted(words, key=order.index)
        need = ceil(threshold * len(words) - 1e-9)
        for p, word in enumerate(words[:len(words) - need + 1]):
            rows.append(F.struct(F.lit(word).alias("word"), F.lit(number).alias("notice"), F.lit(label).alias("label"),
                                 F.lit(p).alias("p"), F.lit(len(words)).alias("size"), F.lit(need).alias("need"),
                                 F.lit(run).alias("run"), _literals(words).alias("notice_words"),
                                 _literals(_telling(words, label, texts, need)).cast("array<string>").alias("telling")))
    prefixes = F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))  # a few words per notice
    least = min(ceil(threshold * len(ws) - 1e-9) for _, ws, _ in texts)
    ranked = (blocks.withColumn("words", F.array_intersect(_literals(order), F.col("words")))  # in the global order
              .withColumn("n", F.size("words")).filter(F.col("n") >= least))
    heads = ranked.select("row", "block", "words", "n", "stretch",
                          F.posexplode(F.slice("words", F.lit(1), F.col("n") - least + 1)).alias("q", "word"))
    left = 1 + F.least(F.col("size") - F.col("p"), F.col("n") - F.col("q")) - 1
    pairs = heads.join(prefixes, "word").filter((F.col("n") >= F.col("need")) & (F.col("q") <= F.col("n") - F.col("need"))
                                                & (left >= F.col("need")))
    def shared(words: Column) -> Column:
        told = F.size(F.array_except(F.col("telling"), words)) == 0
        return F.when(told, F.size(F.array_intersect(words, F.col("notice_words")))).otherwise(F.lit(0))
    # a run that holds most of a notice can be taken to begin with one of its words
    starts = F.filter(F.sequence(F.lit(1), F.size("stretch")),
                      lambda at: F.array_contains(F.col("notice_words"), F.element_at("stretch", at)))
    in_run = F.array_max(F.transform(starts, lambda at: shared(F.slice("stretch", at, F.col("run")))))
    return (pairs.filter(shared(F.col("words")) >= F.col("need")).withColumn("both", in_run)
            .filter(F.col("both") >= F.col("need"))
            .select("row", "block", "label", (F.col("both") / F.col("size")).alias("containment")))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, list[str]] = NOTICES,
         threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` plus the phrase columns, base_labels, labels and score.

    The narrow scan result (with the stretches that may hold a notice) is stored with a
    row number, and what the join finds is put back by that number.
    """
    keep = keep if keep is not None else docs.columns
    vocab = sorted({w for ts in notices.values() for t in ts for w in t.split()})
    made = ["n_words", "n_base", "first_word", "last_word", "base_found"]
    keep = [c for c in keep if c not in (*made, "base_labels", "labels", "score", "__row", "__blocks")]
    base = scan_phrases(docs, phrases)
    longest = max(_run(t, threshold) for ts in notices.values() for t in ts)
    least = min(ceil(threshold * len(set(t.split())) - 1e-9) for ts in notices.values() for t in ts)
    # a text's words go in as a lambda's argument, so they are split once; texts with too few words of every notice have no stretch
    texts = F.transform(F.array(F.split(F.trim("__lined"), "[ \n]+")),
                        lambda ws: F.struct(ws.alias("ws"), F.array_intersect(_literals(vocab), ws).alias("held")))
    whole = F.filter(texts, lambda t: _may_hold(t["held"], notices, threshold))
    cuts = F.transform(F.flatten(F.transform(whole, lambda t: _stretches(t["ws"], longest))),
                       lambda s: F.struct(F.array_intersect(_literals(vocab), s).alias("words"), s.alias("stretch")))
    likely = F.filter(cuts, lambda b: (F.size(b["words"]) >= least) & _may_hold(b["words"], notices, threshold))
    base = cut(base.select(*keep, *made, likely.alias("__blocks"), F.monotonically_increasing_id().alias("__row")))
    blocks = base.select(F.col("__row").alias("row"), F.posexplode("__blocks").alias("block", "b"))
    found = find_notices(blocks.select("row", "block", "b.*"), notices, threshold).groupBy(F.col("row").alias("__row")).agg(
        F.collect_set("label").alias("__labels"), F.max("containment").alias("__best"))
    labels = F.array_sort(F.array_distinct(F.concat("base_found", F.coalesce("__labels", F.array().cast("array<string>")))))
    score = F.greatest(F.coalesce("__best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return (base.join(found, "__row", "left")
            .select(*keep, "n_words", "n_base", "first_word", "last_word",
                    F.concat_ws(",", "base_found").alias("base_labels"), F.concat_ws(",", labels).alias("labels"),
                    score.alias("score")))
