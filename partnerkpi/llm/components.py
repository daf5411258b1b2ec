"""Connected components of an edge list by alternating large-star and small-star rounds (DataFrame joins only).

Labels are the smallest node value reachable. Each round is written to the shared scratch folder, so a lost executor
costs one round. A node with very many neighbours is aggregated map-side first (its minimum), and the join back to its
edges is an ordinary equi-join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _min_neighbour(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges``; self-loops and repeated edges do no harm, an empty list gives no rows."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges", small=True)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_min_neighbour(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = _min_neighbour(down)
        small = (
            down.join(low, "u")
            .select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        nxt = written(small, "edges", small=True)
        # every node is tied to one other, and that one to none: the stars are the components
        tied = nxt.groupBy("u").agg(F.count("*").alias("n"))
        open_ends = tied.where("n > 1").select("u").union(nxt.select("v").join(tied.select(F.col("u").alias("v")), "v", "left_semi"))
        e = nxt
        if open_ends.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
