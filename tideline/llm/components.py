"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least node around."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("_m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
    least = down.groupBy("node").agg(F.min("to").alias("_m"))
    moved = down.join(least, "node").select(F.col("_m").alias("a"), F.col("to").alias("b")).where("a < b")
    own = least.select(F.col("_m").alias("a"), F.col("node").alias("b"))
    return moved.unionByName(own).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``); root is the least node.

    Each round halves the height of every tree at least, so the rounds grow with the logarithm
    of a component's diameter.  Sums are by node with map-side combining and the joins are plain
    equi-joins, so a hub with very many neighbours is split by adaptive execution.  Every round
    is a table in the shared folder: lineage stays short and a lost executor repeats one round.
    """
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name
    )
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if (state["n"], state["h"]) == seen:
            break
        seen = (state["n"], state["h"])
        if not state["n"]:
            break
        edges = written(_small_star(_large_star(edges)), name)
    # A fixed point is a set of stars: each node hangs on the least node of its component.
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
