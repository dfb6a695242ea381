"""Repeated passages removed by compacting a De Bruijn graph of word windows.

Every window of 20 consecutive words is an edge of the graph.  Of equal
windows the first in (doc_id, start) stays, and every word that a later one
covers is removed.

1. One row per text: its words are hashed once, and every window is filed
   under its minimiser (the 6-word piece of the smallest hash in it).  Equal
   windows have equal minimisers, so only windows under a minimiser that
   occurs twice can be repeated; about an eighth as many rows as there are
   windows are shuffled to find them.
2. Those windows become edges: occurrences, windows before, and first source
   coordinate (id, start) per edge, combined before the shuffle.
3. An edge continues the one before it if all its occurrences follow that
   edge and both occur equally often.  Such paths do not branch; their first
   occurrences lie side by side in one text, so ordering the edges by source
   coordinate compacts each path to one row: its head, its length and where
   it is first.
4. The heads are joined back to the windows: each occurrence of a head is a
   span, one row however long it is.
5. The spans' texts are read at their coordinates, their words digested, and
   only spans that agree with an earlier one word for word are removed.  If
   a hash has tied unlike windows, the first of each wording stays and the
   texts concerned are written again.

Copies of a whole text are one node: all but the first lose every word that a
window covers without entering the graph.  A hot passage or piece is combined
before the shuffle, and the joins on it are plain joins of stored tables,
which Spark splits.

Defined cases: null and empty texts have no words.  A text of fewer than 20
words has no window and stays whole.  Null ids come last; texts that share an
id are ordered by a hash of the text; of equal rows one stays.  An empty table
gives an empty result.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwise.llm.common import BROADCAST_ROWS, WORD, small, stage

WINDOW = 20
PIECE = 6  # words of a minimiser
LAST = 2 ** 63 - 1  # the place of null ids

_WORD = re.compile(WORD)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64(0xFFFF)
_NODE = ["doc", "tie"]


class _WordHashes(dict):
    """64-bit hashes of words, kept for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def runs_of(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` consecutive words."""
    n = max(0, len(h) - width + 1)
    z = h[:n].copy()
    for k in range(1, width):
        z *= _ODD
        z ^= z >> np.uint64(29)
        z += h[k:k + n]
    z *= _MIX
    z ^= z >> np.uint64(32)
    return z


def minimisers(h: np.ndarray, window: int = WINDOW, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first window) of each stretch of windows with one minimiser."""
    z = runs_of(h, piece)
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # the place of a piece in the low bits tells pieces apart; a window is far shorter than 65,536
    low = (z & ~_LOW) | (np.arange(len(z), dtype=np.uint64) & _LOW)
    width, span = window - piece + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[:n], low[width - span:])
    starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    at = starts + ((low[starts] - starts.astype(np.uint64)) & _LOW).astype(np.int64)
    return z[at], starts


def _digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _sha(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def _lists(parts: list[np.ndarray], kind: pa.DataType, dtype) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    flat = np.concatenate(parts).astype(dtype) if parts else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _summaries(window: int):
    def summaries(batches):
        for batch in batches:
            counts, shas, pieces = [], [], []
            for text in batch.column(3).to_pylist():
                words = _WORD.findall(text) if text else []
                counts.append(len(words))
                shas.append(_sha(words))
                pieces.append(minimisers(word_hashes(words), window)[0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
                 _lists(pieces, pa.int64(), np.int64)], names=["doc_id", "low", "digest", "n_words", "sha", "pieces"])
    return summaries


def _edges(window: int, mask: int):
    """Rows of (doc, tie, first window, window before, window hashes): one per stretch of marked windows."""
    def edges(batches):
        for batch in batches:
            out = {"doc": [], "tie": [], "at": [], "before": []}
            hashes = []
            for doc, tie, text, marks in zip(*(c.to_pylist() for c in batch.columns)):
                h = word_hashes(_WORD.findall(text))
                starts = minimisers(h, window)[1]
                z = (runs_of(h, window) & np.uint64(mask)).view(np.int64)
                ends = np.append(starts[1:], len(z))
                marked = np.zeros(len(z) + 2, np.int8)
                for k in set(marks):
                    marked[starts[k] + 1:ends[k] + 1] = 1
                edge = np.diff(marked)
                for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    out["doc"].append(doc)
                    out["tie"].append(tie)
                    out["at"].append(a)
                    out["before"].append(int(z[a - 1]) if a else None)
                    hashes.append(z[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc"], pa.int64()), pa.array(out["tie"], pa.int64()), pa.array(out["at"], pa.int32()),
                 pa.array(out["before"], pa.int64()), _lists(hashes, pa.int64(), np.int64)],
                names=["doc", "tie", "at", "before", "hashes"])
    return edges


_CHECKED = "doc long, tie long, n_removed long, kept_sha string, seen array<struct<h:long,at:int,digest:binary>>"


def _cut_texts(window: int):
    def cut_texts(batches):
        for batch in batches:
            rows = {"doc": [], "tie": [], "n_removed": [], "kept_sha": [], "seen": []}
            for doc, tie, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                words = _WORD.findall(text)
                keep = np.ones(len(words), bool)
                seen = []
                for s in spans:
                    end = s["at"] + s["length"] + window - 1
                    seen.append({"h": s["h"], "at": s["at"], "digest": _digest(words[s["at"]:end])})
                    if not s["first"]:
                        keep[s["at"]:end] = False
                rows["doc"].append(doc)
                rows["tie"].append(tie)
                rows["n_removed"].append(int(len(words) - keep.sum()))
                rows["kept_sha"].append(_sha([words[i] for i in np.flatnonzero(keep).tolist()]))
                rows["seen"].append(seen)
            seen_type = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("digest", pa.binary())]))
            yield pa.RecordBatch.from_pydict(
                {"doc": pa.array(rows["doc"], pa.int64()), "tie": pa.array(rows["tie"], pa.int64()),
                 "n_removed": pa.array(rows["n_removed"], pa.int64()), "kept_sha": pa.array(rows["kept_sha"], pa.string()),
                 "seen": pa.array(rows["seen"], seen_type)})
    return cut_texts


def _place(doc: str = "doc", tie: str = "tie", at: str = "at"):
    return F.struct(F.col(doc).alias("doc"), F.col(tie).alias("tie"), F.col(at).alias("at"))


class _Corpus:
    """The texts of a table by node: (doc, tie) names one text."""

    def __init__(self, docs: DataFrame, window: int):
        self.keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.xxhash64(F.coalesce("text", F.lit(""))).alias("low"),
                                 F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest"), "text")
        schema = "doc_id long, low long, digest binary, n_words long, sha string, pieces array<long>"
        rows = self.keyed.mapInArrow(_summaries(window), schema)
        self.rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), "*",
                                      F.coalesce("doc_id", F.lit(LAST)).alias("doc")))
        # an id that several texts share is told apart by the text's hash
        shared = self.rows.groupBy("doc").agg(F.min("low").alias("a"), F.max("low").alias("b")).filter("a != b")
        self.shared = stage(shared.select("doc", F.lit(True).alias("shared")))
        self.any_shared = self.shared.count() > 0
        groups = self.rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "row")).alias("first"))
        self.groups = stage(groups.filter("n > 1").select("digest", F.col("first.row").alias("first_row")))
        twins = self.rows.groupBy("doc", "low").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        self.twins = stage(twins.select("doc", "low", F.lit(True).alias("twin")))
        self.any_twins = self.twins.count() > 0
        self.rows = (self.tied(self.rows).join(small(self.groups), "digest", "left")
                     .withColumn("copy", F.coalesce(F.col("row") != F.col("first_row"), F.lit(False))))

    def tied(self, df: DataFrame) -> DataFrame:
        if not self.any_shared:
            return df.withColumn("tie", F.lit(0).cast("long"))
        return df.join(small(self.shared), "doc", "left").withColumn(
            "tie", F.when(F.col("shared"), F.col("low")).otherwise(F.lit(0).cast("long"))).drop("shared")

    def texts(self) -> DataFrame:
        """(doc, tie, text) of every text, equal rows once."""
        base = self.keyed.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "low", "text")
        if self.any_twins:
            marked = base.join(small(self.twins), ["doc", "low"], "left")
            once = marked.filter("twin").groupBy("doc", "low").agg(F.first("text").alias("text"))
            base = marked.filter("twin IS NULL").select("doc", "low", "text").unionByName(once.select("doc", "low", "text"))
        return self.tied(base).select("doc", "tie", "text")

    def with_texts(self, found: DataFrame) -> DataFrame:
        """``found`` (one row a node) with the nodes' texts; texts of other nodes are left out before the join."""
        texts = self.texts()
        if found.count() <= BROADCAST_ROWS:
            texts = texts.join(F.broadcast(found.select(*_NODE)), _NODE, "left_semi")
        return texts.join(found, _NODE)


def repeated_spans(corpus: _Corpus, window: int = WINDOW, mask: int = 2 ** 64 - 1) -> DataFrame:
    """(doc, tie, at, h, length, first): the occurrences of repeated nonbranching paths.

    ``at`` is the number of the span's first window, ``length`` its windows,
    ``first`` marks the source of the path.
    """
    nodes = corpus.rows.filter(~F.col("copy") & (F.size("pieces") > 0))
    pieces = nodes.select(*_NODE, F.posexplode("pieces").alias("k", "piece"))
    repeated = stage(pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("piece"))
    marks = stage(pieces.join(repeated, "piece").groupBy(*_NODE).agg(F.collect_list("k").alias("marks")))
    stretches = stage(corpus.with_texts(marks).select(*_NODE, "text", "marks").mapInArrow(
        _edges(window, mask), "doc long, tie long, at int, before long, hashes array<long>"))
    every = stretches.select(*_NODE, "at", "before", "hashes", F.posexplode("hashes").alias("k", "h")).select(
        *_NODE, (F.col("at") + F.col("k")).alias("at"), "h",
        F.when(F.col("k") == 0, F.col("before")).otherwise(F.get("hashes", F.col("k") - 1)).alias("before"))
    edges = every.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.count("before").alias("known"), F.min("before").alias("a"),
        F.max("before").alias("b"), F.min(_place()).alias("place")).filter("n > 1")
    order = Window.partitionBy(*_NODE).orderBy("at")
    placed = edges.select("h", "n", "known", "a", "b", "place.*")
    follows = ((F.lag("at").over(order) == F.col("at") - 1) & (F.lag("h").over(order) == F.col("a"))
               & (F.lag("n").over(order) == F.col("n")) & (F.col("a") == F.col("b")) & (F.col("known") == F.col("n")))
    paths = placed.withColumn("head", F.when(follows, 0).otherwise(1)).withColumn(
        "path", F.sum("head").over(order)).groupBy(*_NODE, "path").agg(
        F.count(F.lit(1)).cast("int").alias("length"), F.min(F.struct("at", "h")).alias("head"))
    heads = stage(paths.select("head.h", "length", _place(at="head.at").alias("source")))
    return stage(every.select(*_NODE, "at", "h").join(small(heads), "h")
                 .withColumn("first", _place() == F.col("source")).drop("source"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, mask: int = 2 ** 64 - 1) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs``.

    ``mask`` takes bits from the windows' hashes; it is for tests of the
    verification.
    """
    corpus = _Corpus(docs, window)
    spans = repeated_spans(corpus, window, mask)

    def checked(spans: DataFrame) -> DataFrame:
        per = stage(spans.groupBy(*_NODE).agg(F.collect_list(F.struct("at", "length", "h", "first")).alias("spans")))
        return stage(corpus.with_texts(per).select(*_NODE, "text", "spans").mapInArrow(_cut_texts(window), _CHECKED))

    done = checked(spans)
    seen = done.select(*_NODE, F.explode("seen").alias("s")).select(*_NODE, "s.*")
    sources = stage(seen.groupBy("h", "digest").agg(F.min(_place()).alias("place")).select("h", "place.*"))
    # sources that the hash took for later occurrences of another wording
    missed = stage(sources.join(spans.filter(~F.col("first")), ["h", *_NODE, "at"], "left_semi")
                   .withColumn("source", F.lit(True)))
    if missed.limit(1).count():
        done = checked(spans.join(missed, ["h", *_NODE, "at"], "left")
                       .withColumn("first", F.col("first") | F.coalesce("source", F.lit(False))).drop("source"))
    whole = F.col("copy") & (F.col("n_words") >= window)
    rows = corpus.rows.select("doc_id", *_NODE, "n_words", "sha", "copy")
    out = rows.join(done.select(*_NODE, "n_removed", "kept_sha"), _NODE, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    changed = ~F.col("copy") & F.col("n_removed").isNotNull()
    return out.select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).when(changed, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(whole, none).when(changed, F.col("kept_sha")).otherwise(F.col("sha")).alias("kept_sha256"))
