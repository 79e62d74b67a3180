"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): nodes have the same root if edges lead from one to the other.

    Each round hooks every node to its least neighbour, follows the hooks twice and contracts the edges to what they
    lead to; rounds grow with the logarithm of a component's size. Every round's tables are written to shared storage.
    No edges give no rows; loops and repeated edges don't matter.
    """
    links = saved(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    reached = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")), "hooks")
        for _ in range(2):
            above = hook.select(F.col("a").alias("up"), F.col("up").alias("top"))
            hook = saved(hook.join(above, "up").select("a", F.col("top").alias("up")), "hooks")
        if reached is None:
            reached = hook.select(F.col("a").alias("node"), F.col("up").alias("root"))
        else:
            step = hook.select(F.col("a").alias("root"), "up")
            reached = saved(reached.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        a, b = hook.select("a", F.col("up").alias("ra")), hook.select(F.col("a").alias("b"), F.col("up").alias("rb"))
        links = links.join(a, "a").join(b, "b").where("ra <> rb")
        links = saved(links.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if not links.limit(1).count():
            return reached
