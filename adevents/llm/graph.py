"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adevents.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` (longs); the root is the component's smallest node.

    Every round hooks each node to its smallest neighbour, follows the hooks to
    their ends by doubling, and contracts the edges to the ends, until no edge
    is left.  A round leaves at most half of a component's nodes, and doubling
    takes the logarithm of a chain's length, so long chains need few steps.
    Each step's tables are written to the checkpoint folder.
    """
    edges = saved(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        hook = _ends(saved(hook.select("node", F.least("node", "near").alias("root")), "hooks"))
        of_a = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        of_b = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = saved(
            edges.join(of_a, "a").join(of_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "edges",
        )
        labels = hook if labels is None else saved(_follow(labels, hook), "labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _follow(labels: DataFrame, hook: DataFrame) -> DataFrame:
    up = hook.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return labels.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _ends(hook: DataFrame) -> DataFrame:
    """``node, root`` with every node's hooks followed to the end."""
    while True:
        up = hook.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = hook.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved"))
        step = saved(step, "hooks")
        if step.where("moved").isEmpty():
            return hook
        hook = step.drop("moved")
