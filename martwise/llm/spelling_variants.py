"""Spelling variants of a corpus's words grouped by a trie-node pair dictionary.

Two words are near if one inserted, deleted or replaced letter turns one into
the other.  A rare word's form is its most frequent near word, if that is ten
times as frequent.

1. Words are counted per task and summed.
2. The words, sorted over the cluster, number the nodes of their trie: a word
   shares the nodes of its common beginning with the word before it and opens
   new ones for the rest.  Each range numbers its own; a running sum over the
   ranges (one row each) and the path that is open at a range's start make the
   numbers global.  A word's place in the order is its id.  The reversed words
   number the trie of endings in the same way.
3. A word of L letters makes integer pairs: (node of the beginning, node of
   the ending) of its L + 1 cuts, and of the L cuts that skip a letter.  Words
   that share a skipping pair differ by one replaced letter; a skipping pair
   that is another word's plain cut is one inserted letter.  Of equal letters
   in a row only the first counts as inserted, so each near word is met once.
4. Pairs are shuffled and sorted; a pair holds at most one word per letter of
   the alphabet and one plain cut.  Each member gets its number of near words
   there and the best of them, so no word pairs are emitted.  They are summed
   per word.
5. Forms are followed by doubling; a form is ten times as frequent, so the
   chains are as long as the logarithm of the largest count.

Defined cases: null and empty texts have no words; a null id counts as the
text ``null``.  Equal rows count as often as they are there.  Words may be of
any length; work and rows grow with their letters.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwise.llm.common import stage

MIN_LETTERS = 7
MIN_COUNT = 2
TIMES = 10
FLUSH = 300_000  # words counted in a task before they are handed on

_RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CUT, SKIP, FIRST_SKIP = 0, 1, 2  # kinds of a pair: plain, skips a letter, skips the first of equal letters


def spelled(doc_id: int | None, run: str) -> str:
    """The word that a document makes of a lower-cased run: some lose a letter."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % 31:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def text_words(doc_id: int | None, text: str | None) -> Counter:
    """Counts of the words of a text that are long enough."""
    lowered: Counter = Counter()
    for run, n in Counter(_RUN.findall(text) if text else ()).items():
        lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    out: Counter = Counter()
    for run, n in lowered.items():
        word = spelled(doc_id, run)
        if len(word) >= MIN_LETTERS:
            out[word] += n
    return out


def _counted(batches):
    def rows(total):
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                          names=["word", "n"])
    total: dict[str, int] = {}
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in text_words(doc_id, text).items():
                total[word] = total.get(word, 0) + n
        if len(total) > FLUSH:
            yield rows(total)
            total = {}
    yield rows(total)


def count_words(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times or more."""
    parts = docs.select("doc_id", "text").mapInArrow(_counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def common(a: str, b: str) -> int:
    """Letters of the common beginning."""
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


def _lists(parts: list) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    flat = np.concatenate([np.asarray(x, np.int64) for x in parts]) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _numbered(batches):
    """Adds (shard, at, path): the place in the sorted range, and the numbers of the key's trie nodes, the root first."""
    before, path, count, at = "", [0], 1, 0
    for batch in batches:
        paths = []
        for key in batch.column(0).to_pylist():
            k = common(before, key)
            path = path[:k + 1] + list(range(count, count + len(key) - k))
            count += len(key) - k
            before = key
            paths.append(path)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)),
             pa.array(np.arange(at, at + n, dtype=np.int64)), _lists(paths)],
            names=[*batch.schema.names, "shard", "at", "path"])
        at += n


def number_trie(words: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, int, list[int]]]]:
    """The rows of ``words`` (``key`` first) sorted and numbered, and how a range's numbers become global.

    For each range: (ids before it, nodes before it, numbers of the nodes that
    its first key shares with the key before).  A number up to the last of
    those stands for a shared node.
    """
    types = ", ".join(f"{c} {t}" for c, t in words.dtypes)
    ordered = words.repartitionByRange("key").sortWithinPartitions("key")
    rows = stage(ordered.mapInArrow(_numbered, f"{types}, shard int, at long, path array<long>"))
    ends = rows.groupBy("shard").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.max_by("path", "at").alias("path"),
        F.count(F.lit(1)).alias("n"), (F.max(F.array_max("path")) + 1).alias("nodes"))
    bases, ids, nodes, high, path = {}, 0, 0, None, []
    for r in sorted(ends.collect(), key=lambda r: r["shard"]):  # one row a range
        shared = path[:common(high, r["low"]) + 1] if high is not None else []
        bases[r["shard"]] = (ids, nodes, shared)
        path = [shared[x] if x < len(shared) else nodes + x for x in r["path"]]
        ids, nodes, high = ids + r["n"], nodes + r["nodes"], r["high"]
    return rows, bases


class _Global:
    """Turns the numbers of the ranges into global ones."""

    def __init__(self, bases: dict[int, tuple[int, int, list[int]]]):
        top = max(bases, default=-1) + 1
        self.ids, self.nodes = np.zeros(top, np.int64), np.zeros(top, np.int64)
        self.shared, self.start = np.zeros(top, np.int64), np.zeros(top, np.int64)
        flat: list[int] = []
        for k, (ids, nodes, shared) in bases.items():
            self.ids[k], self.nodes[k], self.shared[k], self.start[k] = ids, nodes, len(shared), len(flat)
            flat += shared
        self.flat = np.array(flat or [0], np.int64)

    def of(self, shard: np.ndarray, x: np.ndarray) -> np.ndarray:
        open_ = x < self.shared[shard]
        return np.where(open_, self.flat[np.where(open_, self.start[shard] + x, 0)], self.nodes[shard] + x)


def _pairs(forward: _Global, backward: _Global):
    """Rows of (prefix node, suffix node, id, n, kind)."""
    def pairs(batches):
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            words = col["word"].to_pylist()
            if not words:
                continue
            lens = np.array([len(w) for w in words])
            ends = np.cumsum(lens + 1)
            row = np.repeat(np.arange(len(words)), lens + 1)
            shard, back = col["first_shard"].to_numpy()[row], col["shard"].to_numpy()[row]
            pre = forward.of(shard, col["prefixes"].flatten().to_numpy())
            flip = (ends - lens - 1 + ends - 1)[row] - np.arange(len(row))  # endings by place, not by length
            suf = backward.of(back, col["path"].flatten().to_numpy())[flip]
            ids = forward.ids[col["first_shard"].to_numpy()] + col["id"].to_numpy()
            n = col["n"].to_numpy()
            skip = np.ones(len(row), bool)
            skip[ends - 1] = False  # places that have a letter
            skip = np.flatnonzero(skip)
            letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
            first = np.ones(len(letters), bool)
            first[1:] = letters[1:] != letters[:-1]
            first[(np.cumsum(lens) - lens)] = True
            kind = np.concatenate((np.full(len(row), CUT), np.where(first, FIRST_SKIP, SKIP))).astype(np.int8)
            who = np.concatenate((row, row[skip]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((pre, pre[skip]))), pa.array(np.concatenate((suf, suf[skip + 1]))),
                 pa.array(ids[who]), pa.array(n[who]), pa.array(kind)], names=["pre", "suf", "id", "n", "kind"])
    return pairs


def _best(group: np.ndarray, n: np.ndarray, ids: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (or -1) of the first and second row of each group: largest n, then smallest id."""
    order = np.lexsort((ids, -n, group))
    g = group[order]
    out = np.full((2, groups), -1)
    head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.empty(0, np.int64)
    out[0, g[head]] = order[head]
    second = head + 1
    second = second[second < len(g)]
    second = second[g[second] == g[second - 1]]
    out[1, g[second]] = order[second]
    return out[0], out[1]


def near_in_pairs(pre, suf, ids, n, kind):
    """(id, near words, best count, best id) of the members of whole pairs, rows sorted by pair."""
    new = np.concatenate(([True], (pre[1:] != pre[:-1]) | (suf[1:] != suf[:-1])))
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    ids, n, kind = ids[many], n[many], kind[many]
    group = np.unique(group[many], return_inverse=True)[1]
    groups = int(group[-1]) + 1 if len(group) else 0
    cut, skip, first = kind == CUT, kind != CUT, kind == FIRST_SKIP
    skips = np.bincount(group[skip], minlength=groups)
    firsts = np.bincount(group[first], minlength=groups)
    plain = np.full(groups, -1)
    plain[group[cut]] = np.flatnonzero(cut)
    at = np.flatnonzero(skip)
    one, two = (np.where(x >= 0, at[x], -1) if len(at) else x for x in _best(group[skip], n[skip], ids[skip], groups))
    of = np.flatnonzero(first)
    lead = _best(group[first], n[first], ids[first], groups)[0]
    lead = np.where(lead >= 0, of[lead], -1) if len(of) else lead
    row = np.arange(len(ids))
    other = np.where(one[group] == row, two[group], one[group])  # best of the others that skip here
    plain_of = np.where(first, plain[group], -1)
    better = (plain_of >= 0) & ((other < 0) | (n[plain_of] > n[other]) | ((n[plain_of] == n[other]) & (ids[plain_of] < ids[other])))
    best = np.where(cut, lead[group], np.where(better, plain_of, other))
    near = np.where(cut, firsts[group], skips[group] - 1 + (plain_of >= 0))
    has = near > 0
    return ids[has], near[has], n[best[has]], ids[best[has]]


def _near(batches):
    """Cuts the sorted rows between pairs; the last pair of a batch waits for the next."""
    def rows(cols):
        ids, near, n, best = near_in_pairs(*cols)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near.astype(np.int64)), pa.array(n), pa.array(best)],
                                          names=["id", "near", "best_n", "best_id"])
    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        size += batch.num_rows
        if size < 50_000:
            continue
        cols = [np.concatenate(x) for x in zip(*held)]
        other = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        end = int(other[-1]) + 1 if len(other) else 0
        if end:
            yield rows([c[:end] for c in cols])
        held, size = [[c[end:] for c in cols]], len(cols[0]) - end
    if size:
        yield rows([np.concatenate(x) for x in zip(*held)])


def near_words(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) with ids in code-point order, and (id, n_near, best_n, best_id) of words that have near ones."""
    rows, forward = number_trie(words.select(F.col("word").alias("key"), "n"))
    back, backward = number_trie(rows.select(F.reverse("key").alias("key"), F.col("key").alias("word"), "n",
                                             F.col("shard").alias("first_shard"), F.col("at").alias("id"),
                                             F.col("path").alias("prefixes")))
    pairs = back.mapInArrow(_pairs(_Global(forward), _Global(backward)), "pre long, suf long, id long, n long, kind byte")
    near = pairs.repartition("pre", "suf").sortWithinPartitions("pre", "suf").mapInArrow(
        _near, "id long, near long, best_n long, best_id long")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("low"))).alias("best")
    summed = stage(near.groupBy("id").agg(F.sum("near").alias("n_near"), best).select(
        "id", "n_near", "best.best_n", (-F.col("best.low")).alias("best_id")))
    spark = words.sparkSession
    starts = spark.createDataFrame([(k, b[0]) for k, b in forward.items()], "shard int, start long")  # one row a range
    named = stage(rows.join(F.broadcast(starts), "shard").select(
        (F.col("start") + F.col("at")).alias("id"), F.col("key").alias("word"), "n"))
    return named, summed


def variants(docs: DataFrame, times: int = TIMES, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word."""
    named, near = near_words(count_words(docs, min_count))
    known = stage(named.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= times * F.col("n"), F.col("best_id")).alias("form_id")))
    # (id, root): each step takes the root of the root, so its reach doubles
    roots = stage(known.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("root")))
    while True:
        up = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = stage(roots.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved")))
        roots = step.select("id", "root")
        if not step.filter("moved").limit(1).count():
            break
    names = named.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    tops = named.select(F.col("id").alias("root_id"), F.col("word").alias("top"))
    formed = (known.filter("form_id IS NOT NULL").join(names, "form_id")
              .join(roots.select("id", F.col("root").alias("root_id")), "id").join(tops, "root_id"))
    alone = known.filter("form_id IS NULL")
    none = F.lit(None)
    return formed.select("word", "form", F.col("top").alias("root"), "n", "n_near", "form_n").unionByName(
        alone.select("word", none.cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near",
                     none.cast("long").alias("form_n")))
