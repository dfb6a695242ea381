"""Connected components: within a task, and of an edge table in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwise.llm.common import cut


class Forest:
    """Union-find over the links that one task finds."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def tie(self, x: int, y: int) -> None:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component) for every id in ``edges`` (columns src, dst: long).

    ``component`` is the smallest id reachable.  Each round takes the
    smallest label of the neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest path.  A round is one
    join on the edges and one on the labels, with a stored result; a hub's
    edges are reduced map-side and its join is split by AQE.
    """
    pairs = edges.filter(F.col("src") != F.col("dst")).select("src", "dst")
    both = cut(pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut(both.groupBy("src").agg(F.min("dst").alias("m"))
                 .select(F.col("src").alias("id"), F.least("src", "m").alias("component")))
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("id", "dst"), "dst")
                .groupBy(F.col("src").alias("id")).agg(F.min("component").alias("m")))
        step = labels.join(near, "id").select("id", F.col("component").alias("old"),
                                              F.least("component", "m").alias("to"))
        up = labels.select(F.col("id").alias("to"), F.col("component").alias("top"))
        new = cut(step.join(up, "to").select("id", F.col("top").alias("component"),
                                             (F.col("old") != F.col("top")).alias("changed")))
        labels = new.select("id", "component")
        if not new.filter("changed").limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def gather(part: DataFrame) -> DataFrame:
    """(key, links, component) from what tasks found: (key, links, top) rows.

    A key's links are summed over the tasks; each task's forest ties its keys
    to their top, and the components of those ties are the classes.
    """
    part = cut(part)
    ties = connected_components(part.select(F.col("key").alias("src"), F.col("top").alias("dst")))
    linked = part.groupBy("key").agg(F.sum("links").alias("links"))
    return cut(linked.join(ties.select(F.col("id").alias("key"), "component"), "key"))
