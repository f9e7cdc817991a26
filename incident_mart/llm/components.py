"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Edges of a graph that one task takes (about 100 MB there).
ONE_TASK = 300_000


def _minimum(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``; partial minima are taken before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` hangs on one ``v`` and no ``v`` hangs on anything."""
    below = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    above = edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    ends = below.union(above).groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.where("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def _by_union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stars of a graph of at most ONE_TASK edges: every node below the smallest it reaches."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    stars = [(node, root(node)) for node in list(parent)]
    stars = [x for x in stars if x[0] != x[1]]
    columns = [pa.array([x[k] for x in stars], pa.int64()) for k in (0, 1)]
    yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])


def connected_components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """Rows ``node, component`` for every node of ``links`` (columns ``u``, ``v``).

    ``component`` is the smallest node that can be reached. Up to ``one_task`` distinct
    edges go to one task. Beyond, large-star and small-star steps in turn hang each node
    below ever smaller neighbours until the graph is a set of stars; every round writes
    its edges, so a lost executor costs one round at most. Results are the same.
    Self links make a component of one; repeated links and either order are fine.
    """
    nodes = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    small = edges.count() <= one_task
    if small:
        edges = stored(edges.repartition(1).mapInArrow(_by_union, "u long, v long"), "stars")
    while not small and not _are_stars(edges):
        # Large star: a node's larger neighbours move below its smallest one.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_minimum(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
            .distinct()
        )
        large = stored(large, "large-star")
        # Small star: a node and its smaller neighbours move below the smallest of them.
        low = _minimum(large)
        below = (
            large.join(low, "u")
            .where("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(low.select("u", F.col("low").alias("v")))
            .distinct()
        )
        edges = stored(below, "small-star")
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
