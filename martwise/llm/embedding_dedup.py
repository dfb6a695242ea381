"""Near-duplicate vectors by an inverted multi-index.

The halves of the vectors get a codebook each; the pairs of codes are cells.
A vector is stored in its nearest cell and visits cells in order of their
distance (the sum over the halves), as a multi-sequence traversal does, until
the target recall is met; the vectors of the visited cells are compared
exactly in double precision.

The number of cells to visit is calibrated when the codebooks are fitted: for
sampled vectors a partner at exactly the threshold is drawn in a random
direction, and enough cells are visited to meet the partner's cell at the
target recall.  A pair is found if either vector visits the other's cell.

Codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed.
Equal vectors are one node and never compared.  A cell is dealt out as pairs
of blocks of its members and visitors, and tasks return link counts and a
spanning forest, never pairs.

Defined cases: null, empty and zero vectors and those with null or non-finite
components link with nothing and are components of their own; so do vectors of unlike
length.  ``component_id`` is the smallest vec_id of the component; ``kept`` is
vec_id = component_id (null ids agree), so rows that agree in id agree in it.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwise.llm.common import cut
from martwise.llm.components import Forest, gather

THRESHOLD = 0.95
RECALL = 0.99
SAMPLE = 20_000
CELL_VECTORS = 128  # aim for so many vectors a cell
MIN_CODES, MAX_CODES = 4, 256
MEMBERS, VISITORS = 1024, 4096  # of a block


def usable(v: Column) -> Column:
    """Not null, finite throughout, and not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _squares(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)[None, :]


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(3)
    codes = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = _squares(x, codes).argmin(1)
        for c in range(len(codes)):
            own = x[at == c]
            if len(own):
                codes[c] = own.mean(0)
    return codes


class Index:
    """Two codebooks and the number of cells that a vector visits."""

    def __init__(self, left: np.ndarray, right: np.ndarray, visits: int):
        self.left, self.right, self.visits = left, right, visits
        # the n nearest cells lie where (rank left + 1) * (rank right + 1) <= n
        n = min(visits, len(left) * len(right))
        grid = [(i, j) for i in range(len(left)) for j in range(len(right)) if (i + 1) * (j + 1) <= n]
        self.i, self.j = np.array(grid).T if grid else (np.zeros(1, int), np.zeros(1, int))

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Cells in the order visited, the vector's own first (unit vectors, rows)."""
        half = self.left.shape[1]
        a, b = _squares(x[:, :half], self.left), _squares(x[:, half:], self.right)
        order_a, order_b = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        a, b = np.take_along_axis(a, order_a, 1), np.take_along_axis(b, order_b, 1)
        total = a[:, self.i] + b[:, self.j]
        n = min(self.visits, total.shape[1])
        near = total.argsort(1, kind="stable")[:, :n]
        cells = np.take_along_axis(order_a, self.i[near], 1) * len(self.right) + np.take_along_axis(order_b, self.j[near], 1)
        return cells.astype(np.int32)


def fit(x: np.ndarray, codes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Index:
    """Codebooks and calibrated visits from sampled unit vectors."""
    half = x.shape[1] // 2
    left, right = _kmeans(x[:, :half], codes), _kmeans(x[:, half:], codes)
    every = Index(left, right, len(left) * len(right))
    rng = np.random.default_rng(5)
    ranks = []
    for _ in range(4):
        base = x[rng.choice(len(x), min(len(x), 500), replace=False)]
        away = rng.normal(size=base.shape)
        away -= (away * base).sum(1)[:, None] * base
        size = np.linalg.norm(away, axis=1)[:, None]
        partner = threshold * base + sqrt(1 - threshold ** 2) * np.divide(away, size, out=np.zeros_like(away), where=size > 0)
        home = every.cells(partner)[:, 0]
        ranks.append((every.cells(base) == home[:, None]).argmax(1))
    visits = int(np.quantile(np.concatenate(ranks), recall)) + 1
    return Index(left, right, visits)


def _unit(parts: pd.Series | list, width: int) -> np.ndarray:
    x = np.zeros((len(parts), width))
    for k, v in enumerate(parts):
        x[k, :len(v)] = v
    x /= np.abs(x).max(axis=1)[:, None]  # the squares of very large or small components leave the doubles' range
    return x / np.linalg.norm(x, axis=1)[:, None]


def build_index(nodes: DataFrame, count: int, width: int, threshold: float = THRESHOLD, recall: float = RECALL,
                sample: int = SAMPLE) -> Index:
    """Fit the codebooks in one task on the bounded sample."""
    codes = max(MIN_CODES, min(MAX_CODES, ceil(sqrt(count / CELL_VECTORS))))

    def fit_rows(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key")
        index = fit(_unit(part["embedding"].tolist(), width), codes, threshold, recall)
        return pd.DataFrame({"left": [index.left.tobytes()], "right": [index.right.tobytes()], "visits": [index.visits]})
    chosen = nodes.select("key", "embedding").orderBy(F.xxhash64("key"), "key").limit(sample)
    got = chosen.groupBy(F.lit("one")).applyInPandas(fit_rows, "left binary, right binary, visits long").first()
    half = width // 2
    return Index(np.frombuffer(got["left"]).reshape(-1, half), np.frombuffer(got["right"]).reshape(-1, width - half), got["visits"])


def _visits(index: Index, width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = [np.asarray(v, np.float64) for v in batch.column(2).to_pylist()]
            cells = index.cells(_unit(vectors, width))
            n = cells.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in vectors], pa.binary()),
                 pa.array(cells[:, 0]), pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * n),
                                                                 pa.array(cells.ravel()))],
                names=["key", "copies", "vector", "home", "cells"])
    return rows


def _compare(width: int, threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        links: dict[int, int] = {}
        forest = Forest()
        members, visitors = rows[rows["member"]], rows[~rows["member"]]
        if len(members) and len(visitors):
            def unpack(part):
                lens = part["vector"].str.len().to_numpy() // 8
                raw = [np.frombuffer(v) for v in part["vector"]]
                return (part["key"].to_numpy(), part["copies"].to_numpy(), part["home"].to_numpy(), lens, _unit(raw, width))
            key_m, copies_m, _, len_m, x_m = unpack(members)
            key_v, copies_v, home_v, len_v, x_v = unpack(visitors)
            cell = int(rows["cell"].iloc[0])
            seen = np.array(members["cells"].tolist())
            step = max(1, 4_000_000 // len(members))
            for s in range(0, len(visitors), step):
                i, j = np.nonzero(x_v[s:s + step] @ x_m.T >= threshold)
                i += s
                hit = (key_v[i] != key_m[j]) & (len_v[i] == len_m[j])
                i, j = i[hit], j[hit]
                once = np.empty(len(i), bool)  # a pair that meets in two cells counts in one
                for t in range(0, len(i), 100_000):
                    a, b = i[t:t + 100_000], j[t:t + 100_000]
                    home = home_v[a]
                    back = (seen[b] == home[:, None]).any(1)
                    once[t:t + 100_000] = np.where(home == cell, key_v[a] < key_m[b], ~back | (home < cell))
                i, j = i[once], j[once]
                for keys, at, weight in ((key_v, i, copies_m[j]), (key_m, j, copies_v[i])):
                    got = np.bincount(at, weight, len(keys)).astype(np.int64)
                    for x in np.flatnonzero(got):
                        links[int(keys[x])] = links.get(int(keys[x]), 0) + int(got[x])
                for x, y in zip(key_v[i].tolist(), key_m[j].tolist()):
                    forest.tie(x, y)
        keys = list(links)
        return pd.DataFrame({"key": pd.Series(keys, dtype="int64"),
                             "links": pd.Series([links[k] for k in keys], dtype="int64"),
                             "top": pd.Series([forest.top(k) for k in keys], dtype="int64")})
    return compare


def node_links(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(key, links, component) of the nodes (key, embedding, copies) that have a link."""
    count, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not count:
        return nodes.select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("component"))
    width = max(2, width)  # two halves
    index = build_index(nodes, count, width, threshold, recall)
    placed = cut(nodes.select("key", "copies", "embedding").mapInArrow(
        _visits(index, width), "key long, copies long, vector binary, home int, cells array<int>"))
    going = placed.select("key", F.col("home"), F.explode("cells").alias("cell"))
    sizes = going.groupBy("cell").agg(
        F.greatest(F.lit(1), F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / MEMBERS)).cast("int").alias("m_blocks"),
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / VISITORS)).cast("int").alias("v_blocks"))
    sizes = F.broadcast(cut(sizes))  # at most MAX_CODES squared cells
    own = F.pmod(F.xxhash64("key"), F.col("m_blocks")).cast("int")
    visit = F.pmod(F.xxhash64("key", F.lit(1)), F.col("v_blocks")).cast("int")
    cols = ["cell", "m", "v", "member", "key", "copies", "home", "vector", "cells"]
    none = F.array().cast("array<int>")
    members = (placed.withColumn("cell", F.col("home")).join(sizes, "cell").withColumn("m", own)
               .withColumn("v", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1))).withColumn("member", F.lit(True)))
    visitors = (placed.withColumn("cell", F.explode("cells")).withColumn("cells", none).join(sizes, "cell").withColumn("v", visit)
                .withColumn("m", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1))).withColumn("member", F.lit(False)))
    part = members.select(*cols).unionByName(visitors.select(*cols)).groupBy("cell", "m", "v").applyInPandas(
        _compare(width, threshold), "key long, links long, top long")
    return gather(part)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector."""
    ok = usable(F.col("embedding"))
    keyed = vectors.select("vec_id", "embedding", F.when(ok, F.xxhash64("embedding")).alias("key"))
    narrow = cut(keyed.select("vec_id", "key"))
    good = keyed.filter(F.col("key").isNotNull())
    nodes = cut(good.groupBy("key").agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies")))
    linked = node_links(nodes, threshold, recall)
    known = (narrow.filter(F.col("key").isNotNull()).groupBy("key")
             .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"))
             .join(linked, "key", "left")
             .select("key", "low", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("component", "key").alias("component")))
    classes = known.groupBy("component").agg(F.min("low").alias("component_id"))
    facts = known.join(classes, "component").select("key", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    out = narrow.join(facts, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
