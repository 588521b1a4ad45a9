"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dqspark.operators.joins import join_reduced
from dqspark.session import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of the links ``(a, b)``: root is the lowest node it reaches.

    Large-star and small-star rounds: each joins nodes to the lowest neighbour, so a chain shortens by a
    factor every round. A round is a written table in the shared folder, hence its lineage is short and
    a lost executor costs tasks only. Nothing but two numbers a round goes to the driver. A node with many
    links is combined before the shuffle where its minimum is sought; in the join Spark can split it.
    Links of a node to itself and repeated links are allowed; no links give no rows.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(a != b).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        if (then := _state(edges)) == state:
            break
        state = then
    return edges.select(a.alias("node"), b.alias("root")).union(edges.select(b, b).distinct())


def _state(edges: DataFrame) -> tuple[int, object]:
    row = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every higher neighbour of a node is linked to the node's lowest neighbour, or itself."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("a", "b")
    lowest = both.groupBy(F.col("a").alias("of")).agg(F.least(F.min("b"), F.col("of")).alias("low"))
    return join_reduced(both, lowest, "a", "of").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are linked to the lowest of them."""
    lowest = edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))
    moved = join_reduced(edges, lowest, "a", "of").filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(lowest.select(F.col("of").alias("a"), F.col("low").alias("b"))).distinct()
