"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollfold.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): equal labels for connected nodes.

    Each round every node joins the neighbour (or itself) of least hash, with another hash each round, and the edges
    between the merged nodes go on, without repeats; their number falls by a factor each round, for chains and stars alike.
    """
    live = saved(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = saved(live.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    turn = 0
    while not live.isEmpty():
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), F.col(c)), F.col(c).alias("to"))
        parents = live.groupBy("a").agg(F.min(rank("b")).alias("least")).select("a", F.least("least", rank("a"))["to"].alias("to"))
        parents = saved(parents, "parents")
        to_a = parents.select(F.col("a"), F.col("to").alias("na"))
        to_b = parents.select(F.col("a").alias("b"), F.col("to").alias("nb"))
        live = saved(
            live.join(to_a, "a").join(to_b, "b").where("na != nb").select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(), "edges"
        )
        moved = parents.select(F.col("a").alias("label"), "to")
        labels = saved(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        turn += 1
    return labels
