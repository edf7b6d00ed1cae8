"""Connected components of links, without leaving the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _jumped(parents: DataFrame, rows: int) -> DataFrame:
    """``node, parent`` with every parent a root: paths are halved until they
    are all of length one."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
        nxt = stored(
            parents.join(up, "parent", "left").select("node", F.coalesce("over", "parent").alias("parent"), F.col("over").isNotNull().alias("moved")),
            "jump",
            rows=rows,
        )
        moved = nxt.where("moved").limit(1).count()
        drop_stored(parents)
        if not moved:
            return nxt
        parents = nxt


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` for all nodes of ``links`` (columns ``a, b``): the
    smallest node of each component, as a stored table. ``rows``: how many
    links there are at most, if that is known.

    Rounds of hooking and contraction: every node hooks to its smallest smaller
    neighbour, paths are shortened, and links between what remains apart go to
    the next round, each with at most half the roots. Every table lies in the
    shared folder; group minima are combined map-side, and joins are between
    stored tables, whose hot keys Spark can split. Loops and repeated links
    don't matter; no links give no rows.
    """
    ends = lambda df: df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(ends(links), "links", rows=rows)
    left = now.count()
    most = 2 * left
    nodes = stored(now.select(F.col("a").alias("node")).union(now.select("b")).distinct().withColumn("root", F.col("node")), "nodes", rows=most)
    while left:
        hooks = stored(now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "hooks", rows=left)
        jumped = _jumped(hooks, left)
        roots = jumped.select("node", "parent")
        to = lambda df, c: df.join(roots.withColumnsRenamed({"node": c, "parent": "__to"}), c, "left").withColumn(c, F.coalesce("__to", c)).drop("__to")
        nxt = stored(ends(to(to(now, "a"), "b")), "links", rows=left)
        moved = stored(to(nodes, "root"), "nodes", rows=most)
        drop_stored(now, nodes, jumped)
        now, nodes, left = nxt, moved, nxt.count()
    drop_stored(now)
    return nodes
