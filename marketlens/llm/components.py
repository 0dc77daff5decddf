"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Scratch


def labels(scratch: Scratch, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label for each node of a link; nodes have equal labels if links connect them.

    Every round points each node to the first of its neighbours and itself in an order drawn anew
    by hashing, rewrites the links to these targets and keeps those that still join two nodes. With
    such an order a chain shrinks by a constant factor, however its nodes are numbered, so rounds
    grow with the logarithm of the largest component. Links may be in any direction and repeated;
    a node is only ever grouped by partial minimum, so a hub is no hot task.
    """
    edges = scratch.put(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), "edges-0")
    pointers = []
    while not edges.isEmpty():
        turn = len(pointers)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        def rank(col: str, turn: int = turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(col)).alias("h"), F.col(col).alias("to"))

        first = both.groupBy("a").agg(F.min(rank("b")).alias("first"))
        to = scratch.put(first.select("a", F.least("first", rank("a"))["to"].alias("to")), f"to-{turn}")
        pointers.append(to)
        moved = edges.join(to, "a").select(F.col("to").alias("x"), F.col("b").alias("a")).join(to, "a").where("x <> to")
        edges = scratch.put(moved.select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b")).distinct(), f"edges-{turn + 1}")
        scratch.drop(f"edges-{turn}")
    if not pointers:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    found = pointers[0].select(F.col("a").alias("node"), F.col("to").alias("label"))
    for to in pointers[1:]:
        step = to.select(F.col("a").alias("label"), "to")
        found = found.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    found = scratch.put(found, "labels")
    for turn in range(len(pointers)):
        scratch.drop(f"to-{turn}")
    return found
