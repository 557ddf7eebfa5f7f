"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricevault.llm.stored import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node of its component) for each node of ``a``, ``b`` edges.

    A round moves every node to the best node of its neighbourhood and contracts the edges,
    so each works on what the one before left. Best is the least id in the first and every other
    round, which settles stars at once, and the least hash in between, which shortens any chain
    by a constant share. The moves are then composed from the last round back to the first; a node that
    another moved to while it moved itself stands for that other one from then on.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    nodes, rounds = edges, []
    while not edges.isEmpty():
        order = F.lit(0) if len(rounds) % 2 == 0 else F.xxhash64("b", F.lit(len(rounds)))
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b")
        both = both.union(both.select("a", F.col("a").alias("b")))
        best = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(order.alias("order"), "b"))["b"].alias("to"))
        moves = stored(best.where("node <> to"), "moves")
        rounds.append(moves)
        for side in ("a", "b"):
            moved = moves.select(F.col("node").alias("__node"), F.col("to").alias("__to"))
            edges = edges.join(moved, edges[side] == moved["__node"], "left").withColumn(side, F.coalesce("__to", side))
            edges = edges.drop("__node", "__to")
        edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels = nodes.select(F.col("a").alias("node")).union(nodes.select("b")).distinct()
    ends: DataFrame | None = None
    for moves in reversed(rounds):
        if ends is None:
            ends = moves
            continue
        further = ends.select(F.col("node").alias("__node"), F.col("to").alias("__to"))
        mapped = moves.join(further, moves["to"] == further["__node"], "left").select("node", F.coalesce("__to", "to").alias("to"))
        still = ends.join(moves.select("node"), "node", "left_anti").select("node", "to")
        ends = stored(mapped.union(still), "ends")
    if ends is None:
        return labels.withColumn("label", F.col("node"))
    found = labels.join(ends, "node", "left").select("node", F.coalesce("to", "node").alias("root"))
    least = found.groupBy("root").agg(F.min("node").alias("label"))
    return stored(found.join(least, "root").select("node", "label"), "labels")
