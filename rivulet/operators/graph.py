"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.util import stage


def components(edges: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """(node, root) of every node of undirected edges; root is the least node reached.

    Nodes should be digests, so that their order is random: every round points each node to
    its least neighbour and contracts the edges, which takes a number of rounds that grows
    with the logarithm of the size. Minima are combined before each shuffle, so a node with
    any number of edges costs no more than its edges. Tables are written between rounds.
    Roots are put together from the last round back, so that a node is joined once, not once
    a round.
    """
    current = stage(
        edges.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
        .where("x <> y")
        .distinct(),
        "edges",
    )
    steps = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("y").alias("x"), F.col("x").alias("y")))
        step = stage(
            both.groupBy(F.col("x").alias("node"))
            .agg(F.min("y").alias("to"))
            .select("node", F.least("node", "to").alias("to")),
            "step",
        )
        steps.append(step)
        ends = (
            current.join(step.select(F.col("node").alias("x"), F.col("to").alias("tx")), "x")
            .join(step.select(F.col("node").alias("y"), F.col("to").alias("ty")), "y")
            .select(F.least("tx", "ty").alias("x"), F.greatest("tx", "ty").alias("y"))
        )
        current = stage(ends.where("x <> y").distinct(), "edges")
    if not steps:
        return current.select(F.col("x").alias("node"), F.col("y").alias("root"))
    found = steps.pop().withColumnRenamed("to", "root")
    while steps:
        later = found.withColumnRenamed("node", "to")
        roots = steps.pop().join(later, "to", "left")
        found = stage(roots.select("node", F.coalesce("root", "to").alias("root")), "roots")
    return found
