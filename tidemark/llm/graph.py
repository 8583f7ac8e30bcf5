"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    Every round each node goes to the first of itself and its neighbours, and the
    nodes that went to one become one.  Rounds order nodes in turn by their label,
    which settles stars at once, and by a hash of the round's own, which leaves
    two thirds of the nodes or fewer on average whatever the labels and the shape.
    So the rounds grow with the logarithm of the nodes and the tables shrink; the
    last node of an order never stays, so the loop ends by itself.  Each round is
    written, so a lost executor costs one round.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    steps: list[DataFrame] = []
    while not both.isEmpty():
        salt = F.lit(len(steps))

        def place(node: str):
            return F.struct((F.xxhash64(node, salt) if len(steps) % 2 else F.col(node)).alias("rank"), F.col(node).alias("node"))

        first = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        step = stage(first.select(F.col("a").alias("node"), F.least(place("a"), "first")["node"].alias("to")), "steps")
        steps.append(step)
        half = both.join(step.withColumnsRenamed({"node": "a", "to": "x"}), "a").select("x", "b")
        whole = half.distinct().join(step.withColumnsRenamed({"node": "b", "to": "y"}), "b")
        both = stage(whole.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    if not steps:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps.pop()
    while steps:  # a node is where the node it went to is
        later = found.select(F.col("node").alias("to"), F.col("to").alias("end"))
        found = stage(steps.pop().join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to")), "steps")
    least = found.groupBy("to").agg(F.min("node").alias("root"))
    return stage(found.join(least, "to").select("node", "root"), "labels")
