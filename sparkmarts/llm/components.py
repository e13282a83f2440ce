"""Connected components of an edge table: forests inside tasks, then alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _forest(batches):
    """The edges of a task as stars around the smallest node that they connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    ends = [(x, root(x)) for x in parent]
    stars = [(x, r) for x, r in ends if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in stars], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links every larger neighbour of a node (or its not larger ones) to the smallest of them and itself."""
    if larger:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    linked = near.join(low, "a")
    if larger:
        linked = linked.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        linked = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (the smallest node that links reach) of every node in the edges (`a`, `b`).

    Each round first joins what one task holds, so its edges shrink to a forest, then links neighbours across
    tasks. It ends when every node has one link, to a node without one. A hot node's edges are counted before
    the shuffle and its join is one that Spark can split. The driver sees two counts a round.
    """
    while True:
        edges = written(edges.select("a", "b").filter("a <> b").mapInArrow(_forest, "a long, b long").distinct())
        # All are stars once no node has two links and no end of a link has one itself.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        at = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if at.filter("out > 1 OR (out = 1 AND into = 1)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = _star(_star(edges, larger=True), larger=False)
