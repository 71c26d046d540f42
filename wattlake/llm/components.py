"""Connected components: within one block of links in numpy, over all blocks in Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.session import materialise


def spanning_links(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that join what the given links over 0..n-1 join."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    node = np.flatnonzero(root != np.arange(n))
    return node, root[node]


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that ``links(a, b)`` touches; component is its smallest node.

    Alternating stars: each node hands its larger neighbours to its smallest one, then its smaller
    neighbours. Every round is one join on the node, whose small side has a row per node, so a node with
    very many neighbours is split like any skewed join. Rounds are cut by a checkpoint in the shared
    folder. Loops and null ends are left out; no links give no rows.
    """
    pair = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialise(pair.where("u <> v").distinct())
    mark = _signature(now)
    while mark[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        far = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = far.groupBy("u").agg(F.min("v").alias("m"))
        star = far.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(star.union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        seen, mark, now = mark, _signature(after), after
        if seen == mark:
            break
    roots = now.groupBy(F.col("v").alias("node")).agg(F.min("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def least_of_component(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """``(node, least)`` with the least of the whole component, for every row of ``nodes(node, least)``."""
    linked = nodes.join(components, "node", "left")
    linked = linked.select("node", "least", F.coalesce("component", "node").alias("component"))
    least = linked.groupBy("component").agg(F.min("least").alias("least"))
    return linked.select("node", "component").join(least, "component").select("node", "least")


def _signature(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("t"),
    ).first()
    return row.n, row.s, row.t
