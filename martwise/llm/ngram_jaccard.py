"""Near-duplicate join on word shingles with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked if the Jaccard
similarity of their sets is 0.8 or more.

1. Equal texts are one node (a 64-bit hash of the text), so copies are
   never compared or expanded.
2. A node's 128 MinHash values make 32 bands of 4.  A pair at similarity s
   shares no band with probability (1 - s^4)^32: 5e-8 at 0.8.
3. Nodes that share a band are tied to the smallest node of that band (a
   star, not all pairs), and connected components of the stars gather
   everything that can be linked.
4. Within a component, pairs compare their MinHash values 16 at a time and
   drop out as soon as the posterior probability that their similarity
   reaches the threshold, given the matches so far and a uniform prior,
   falls below ``tolerance``.  Of the rest, pairs that share a band are
   verified exactly on the shingles.
   A component over ``BLOCK`` nodes or ``BLOCK_SHINGLES`` shingles is dealt
   out: as pairs of its blocks if it is dense, or band by band, a pair at the
   first band it shares, where that sends fewer rows, as in a long chain
   of texts whose ends have nothing in common.  A band over a block is dealt
   out as pairs of blocks in turn.  Tasks return link counts per node and a
   spanning forest, never pairs.
5. Components of the forest are the classes.

Defined cases: null and empty texts (no words) link with nothing and stay,
each in a class of its own.  A text of fewer than five words is one shingle
of all its words.  ``class_id`` is the smallest doc_id in the class (null if
all are null).  ``keep_one`` leaves one row per class: the smallest doc_id,
nulls last; rows that agree in doc_id are told apart by text, of equal rows
one stays.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwise.llm.common import WORD, cut, small
from martwise.llm.components import Forest, connected_components, gather

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 2048  # nodes of a block, and of a pack of small components
BLOCK_SHINGLES = 4_000_000
ANY = -1  # in place of a band's number: pairs that share any

_WORD = re.compile(WORD)
_rng = np.random.default_rng(20240501)
_MUL = _rng.integers(0, 2 ** 31, HASHES, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2 ** 32, HASHES, dtype=np.int64).astype(np.uint32)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    """64-bit hashes of words, kept for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = _WORD.findall(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    z = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        z *= _ODD
        z ^= z >> np.uint64(29)
        z += h[k:len(h) - n + 1 + k]
    z *= _MIX
    z ^= z >> np.uint64(32)
    return np.unique(z)


def signature(sh: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of a non-empty shingle array, in bounded memory."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (sh >> np.uint64(16)).astype(np.uint32)
    for i in range(0, len(x), 4096):
        y = x[i:i + 4096, None] * _MUL + _ADD
        y ^= y >> np.uint32(15)
        np.minimum(low, y.min(axis=0), out=low)
    return low


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    part = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD
    for k in range(ROWS):
        key = (key ^ part[:, k]) * _MIX
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values: the fewest matches at which a pair stays.

    With a uniform prior the similarity is Beta(m + 1, n - m + 1) after m
    matches of n, and P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def _band_rows(batches):
    for batch in batches:
        keys, sizes, out = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sh = shingles(text)
            if len(sh):
                keys.append(key)
                sizes.append(len(sh))
                out.append(bands(signature(sh)))
        flat = np.concatenate(out) if out else np.empty(0, np.int64)
        offsets = np.arange(len(keys) + 1, dtype=np.int32) * BANDS
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["key", "shingles", "bands"])


def _sketch_rows(batches):
    for batch in batches:
        sh = [shingles(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([signature(s).tobytes() for s in sh], pa.binary()),
             pa.array([s.tobytes() for s in sh], pa.binary())], names=["key", "sig", "sh"])


def _candidates(sig_a: np.ndarray, sig_b: np.ndarray, least: dict[int, int], same: bool):
    """Index pairs that no comparison step has dropped; row by row for a == b."""
    step = max(1, 4_000_000 // max(1, len(sig_b)))
    for start in range(0, len(sig_a), step):
        part = sig_a[start:start + step]
        hits = np.zeros((len(part), len(sig_b)), np.uint8)
        for k in range(STEP):
            hits += part[:, k, None] == sig_b[None, :, k]
        keep = hits >= least[STEP]
        if same:
            keep &= np.arange(len(sig_b))[None, :] > np.arange(start, start + len(part))[:, None]
        i, j = np.nonzero(keep)
        m = hits[i, j].astype(np.int32)
        i += start
        for n in range(STEP, HASHES, STEP):
            if not len(i):
                break
            for s in range(0, len(i), 250_000):
                t = slice(s, s + 250_000)
                m[t] += (sig_a[i[t], n:n + STEP] == sig_b[j[t], n:n + STEP]).sum(axis=1, dtype=np.int32)
            stay = m >= least[n + STEP]
            i, j, m = i[stay], j[stay], m[stay]
        yield i, j


def first_bands(sig_a: np.ndarray, sig_b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first band that each pair shares, ``BANDS`` if none."""
    first = np.full(len(i), BANDS, np.int32)
    for s in range(0, len(i), 250_000):
        open_ = np.arange(s, min(s + 250_000, len(i)))
        for n in range(BANDS):
            own = slice(n * ROWS, (n + 1) * ROWS)
            hit = (sig_a[i[open_], own] == sig_b[j[open_], own]).all(axis=1)
            first[open_[hit]] = n
            open_ = open_[~hit]
            if not len(open_):
                break
    return first


def _overlaps(sh_a: list[np.ndarray], sh_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs (i ascending)."""
    used = np.unique(j)
    vocab, inverse = np.unique(np.concatenate([sh_b[x] for x in used]), return_inverse=True)
    ends = np.cumsum([len(sh_b[x]) for x in used])
    ids = dict(zip(used.tolist(), np.split(inverse, ends[:-1])))
    out = np.empty(len(i), np.int64)
    mark = np.zeros(len(vocab), bool)
    cuts = np.flatnonzero(np.diff(i)) + 1
    for group in np.split(np.arange(len(i)), cuts):
        own = sh_a[i[group[0]]]
        at = np.minimum(np.searchsorted(vocab, own), len(vocab) - 1)
        at = at[vocab[at] == own]
        mark[at] = True
        for s in range(0, len(group), 512):  # partners in pieces, to bound memory
            parts = [ids[x] for x in j[group[s:s + 512]].tolist()]
            starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
            out[group[s:s + 512]] = np.add.reduceat(mark[np.concatenate(parts)], starts, dtype=np.int64)
        mark[at] = False
    return out


def _link(a: pd.DataFrame, b: pd.DataFrame, same: bool, band: int, links: dict, forest: Forest, threshold: float,
          least: dict[int, int]) -> None:
    """Count the links between the rows of ``a`` and ``b`` (``same``: within a):
    of pairs that share a band, or whose first shared band is ``band``."""
    limit = Fraction(threshold).limit_denominator(1_000_000)
    num, den = limit.numerator, limit.denominator

    def unpack(x):
        return (x["key"].to_numpy(), x["copies"].to_numpy(),
                np.frombuffer(b"".join(x["sig"]), np.uint32).reshape(len(x), HASHES),
                [np.frombuffer(s, np.uint64) for s in x["sh"]])
    key_a, copies_a, sig_a, sh_a = unpack(a)
    key_b, copies_b, sig_b, sh_b = (key_a, copies_a, sig_a, sh_a) if same else unpack(b)
    len_a, len_b = np.array([len(s) for s in sh_a]), np.array([len(s) for s in sh_b])
    for i, j in _candidates(sig_a, sig_b, least, same):
        first = first_bands(sig_a, sig_b, i, j)
        here = first < BANDS if band == ANY else first == band
        i, j = i[here], j[here]
        if not len(i):
            continue
        both = _overlaps(sh_a, sh_b, i, j)
        hit = both * den >= (len_a[i] + len_b[j] - both) * num
        i, j = i[hit], j[hit]
        for keys, at, weight in ((key_a, i, copies_b[j]), (key_b, j, copies_a[i])):
            got = np.bincount(at, weight, len(keys)).astype(np.int64)
            for x in np.flatnonzero(got):
                links[int(keys[x])] = links.get(int(keys[x]), 0) + int(got[x])
        for x, y in zip(key_a[i].tolist(), key_b[j].tolist()):
            forest.tie(x, y)


def _verify(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        links: dict[int, int] = {}
        forest = Forest()
        for (_, band), part in rows.groupby(["group", "band"], sort=False):
            first, second = int(part["x"].iloc[0]), int(part["y"].iloc[0])
            if first == second:
                if len(part) > 1:
                    _link(part, part, True, int(band), links, forest, threshold, least)
            else:
                a, b = part[part["block"] == first], part[part["block"] == second]
                if len(a) and len(b):
                    _link(a, b, False, int(band), links, forest, threshold, least)
        keys = list(links)
        return pd.DataFrame({"key": pd.Series(keys, dtype="int64"),
                             "links": pd.Series([links[k] for k in keys], dtype="int64"),
                             "top": pd.Series([forest.top(k) for k in keys], dtype="int64")})
    return verify


def text_key(text=None):
    """The node of a text: texts without a word have none."""
    text = F.col("text") if text is None else text
    return F.when(text.rlike(WORD), F.xxhash64(text))


def _parts():
    """Blocks that hold the rows of a group."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).cast("int")


def _packs(groups: DataFrame, side: int) -> DataFrame:
    """Groups of one block share packs of about half a block; a larger one has its own."""
    total = groups.agg(_parts()).first()[0] or 1
    place = F.pmod(F.xxhash64("group"), F.lit(2 * total))
    pack = F.when(F.col("blocks") > 1, F.col("group")).otherwise(place if side > 0 else -1 - place)
    return groups.select("key", "copies", "group", "band", "blocks", pack.alias("pack"))


def deal(comps: DataFrame, entries: DataFrame) -> DataFrame:
    """(key, copies, group, band, blocks, pack): the groups in which a node meets others.

    ``comps`` has (key, comp, copies, shingles, blocks), ``entries`` (key, number, band).
    A group is a component, or, for a component of several blocks of which
    that sends fewer rows, each band that its nodes share.
    """
    whole = comps.select("key", "copies", "shingles", F.col("comp").alias("group"), F.lit(ANY).alias("band"), "blocks")
    large = comps.filter(F.col("blocks") > 1)
    if large.isEmpty():
        return _packs(whole, 1)
    held = cut(entries.join(small(large.select("key", "comp", "copies", "shingles")), "key"))
    shared = cut(held.groupBy("comp", "number", "band").agg(F.count(F.lit(1)).alias("size"), _parts().alias("blocks"))
                 .filter(F.col("size") > 1))
    at_once = large.groupBy("comp").agg((F.count(F.lit(1)) * F.max("blocks")).alias("at_once"))
    banded = shared.groupBy("comp").agg(F.sum(F.col("size") * F.col("blocks")).alias("banded"))
    sparse = small(cut(at_once.join(banded, "comp").filter(F.col("banded") < F.col("at_once")).select("comp")))
    rest = whole.join(sparse.withColumnRenamed("comp", "group"), "group", "left_anti")
    dealt = cut(held.join(shared, ["comp", "number", "band"]).join(sparse, "comp", "left_semi").select(
        "key", "copies", "shingles", F.col("band").alias("group"), F.col("number").alias("band"), "blocks"))
    return _packs(rest, 1).unionByName(_packs(dealt, -1))


def node_links(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(key, links, component) of every text that is linked with another text.

    ``links`` counts linked documents with other texts, ``component`` is the
    smallest node of the class.
    """
    nodes = docs.select(text_key().alias("key"), "text").filter(F.col("key").isNotNull())
    sketches = cut(nodes.mapInArrow(_band_rows, "key long, shingles long, bands array<long>"))
    entries = sketches.select("key", F.posexplode("bands").alias("number", "band"))
    shared = (entries.groupBy("band").agg(F.min("key").alias("low"), F.max("key").alias("high"))
              .filter(F.col("low") != F.col("high")).select("band", "low"))
    # a node and the smallest nodes of its bands (at most one a band) are tied to the smallest of them all,
    # which leaves about one edge a node
    lows = entries.join(shared, "band").groupBy("key").agg(F.collect_set("low").alias("lows"))
    group = F.array_union("lows", F.array("key"))
    stars = lows.select(F.explode(group).alias("src"), F.array_min(group).alias("dst")).filter(
        F.col("src") != F.col("dst")).distinct()
    comps = connected_components(stars).select(F.col("id").alias("key"), F.col("component").alias("comp"))
    copies = sketches.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.max("shingles").alias("shingles"))
    comps = cut(comps.join(copies, "key"))
    sizes = comps.groupBy("comp").agg(_parts().alias("blocks"))
    comps = cut(comps.join(sizes, "comp"))

    # Texts are read again for the nodes that have a candidate only.
    found = nodes.join(small(comps.select("key")), "key").select("key", "text")
    sketch = found.groupBy("key").agg(F.first("text").alias("text")).mapInArrow(_sketch_rows, "key long, sig binary, sh binary")
    sketch = sketch.join(deal(comps, entries), "key")
    sketch = (sketch.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")))
    schema = "key long, links long, top long"
    part = (sketch.select("pack", "group", "band", "x", "y", "block", "key", "copies", "sig", "sh")
            .groupBy("pack", "x", "y").applyInPandas(_verify(threshold, tolerance), schema))
    return gather(part)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, class_id, n_links) per document."""
    narrow = cut(docs.select("doc_id", text_key().alias("key")))
    nodes = node_links(docs, threshold, tolerance)
    copies = narrow.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("low"))
    known = copies.join(nodes.select("key", "links", "component"), "key", "left").select(
        "key", "low", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "key").alias("component"))
    classes = known.groupBy("component").agg(F.min("low").alias("class_id"))
    facts = known.join(classes, "component").select("key", "class_id", "component",
                                                    (F.col("links") + F.col("copies") - 1).alias("n_links"))
    joined = narrow.join(facts, "key", "left")
    return joined.select("doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                         .alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``docs`` with one document of each class left."""
    nodes = small(node_links(docs, threshold, tolerance).select("key", "component"))
    keyed = docs.withColumn("__key", text_key())
    tagged = keyed.join(nodes.select(F.col("key").alias("__key"), F.col("component").alias("__component")), "__key", "left")
    # one row per class, taken in every map task before the shuffle; wordless rows are never grouped
    tagged = tagged.withColumn("__class", F.coalesce("__component", "__key"))
    order = Window.partitionBy("__class").orderBy(F.col("doc_id").asc_nulls_last(), F.col("text"))
    first = tagged.filter(F.col("__class").isNotNull()).withColumn("__n", F.row_number().over(order)).filter(F.col("__n") == 1)
    bare = tagged.filter(F.col("__class").isNull())
    return first.select(*docs.columns).unionByName(bare.select(*docs.columns))
