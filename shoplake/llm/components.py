"""Connected components of a stored edge table, by alternating star operations.

A large component has a node with very many edges. The least neighbours of nodes are therefore stored before they are joined
with the edges: both sides of the join are then shuffles, of which adaptive execution can split the
large partitions. It could not split the output of an aggregate in the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import stored


def _reach(edges: DataFrame) -> DataFrame:
    """(u, v, m): both directions of every edge, with the least of u and all its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(stored(least.select("u", F.least("u", "m").alias("m")), "least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least node around it."""
    return _reach(edges).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them; edges go from great to small."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    others = down.join(least, "u").where(F.col("v") != F.col("m"))
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ).first()
    return int(row["n"]), int(row["s"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge to another: root is the least of its component.

    ``edges`` has columns u and v. Every round writes its edges to the shared folder; their number
    never grows beyond that of the first round, and it takes about log(n) rounds.
    """
    now = stored(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
