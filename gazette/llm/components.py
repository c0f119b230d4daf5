"""Connected components of a graph given as links, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.session import shared_dir


def smallest_reachable(links: DataFrame, rounds: int = 100) -> DataFrame:
    """The smallest node (component) that each linked node reaches.

    links: long columns a and b, undirected; null ends, loops and repeats do not
    matter. Returns node and component for every node with a link to another.
    Nodes are tied alternately to the smallest neighbour among their larger and
    smaller ones until nothing changes; each round is checkpointed to the shared
    folder.
    """
    shared_dir(links.sparkSession)
    edges = (
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a <> b")
        .distinct()
        .checkpoint()
    )
    before = None
    for _ in range(rounds):
        edges = _small_star(_large_star(edges)).checkpoint()
        state = edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.bool_and(F.expr("u > v")),
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _tied(both: DataFrame) -> DataFrame:
    """Rows (u, v) with the least of u and its v as m.

    The small side is written first, so that a hub's rows can be split in the join.
    """
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least.checkpoint(), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties the larger neighbours of each node to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _tied(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the smallest of them."""
    tied = _tied(edges)
    own = tied.select("u", F.col("m").alias("v"))
    others = tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(others).where("u <> v").distinct()
