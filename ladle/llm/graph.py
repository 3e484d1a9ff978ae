"""Connected components of an edge table, by alternating star contraction. Edges and components stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.session import materialize


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    got = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return int(got[0]), int(got[1] or 0)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (columns a, b; whole numbers): component is its smallest reachable node.

    Edges of a node to itself, repeated edges and an empty table are fine; null ends are ignored. Each round is stored in the
    shared scratch folder, so no lineage grows and a lost executor repeats one round at most.
    """
    now = materialize(_directed(edges.where("a IS NOT NULL AND b IS NOT NULL")), "edges")
    state = _state(now)
    for _ in range(rounds):
        if not state[0]:
            break
        now = materialize(_directed(_small_star(_directed(_large_star(now)))), "edges")
        new = _state(now)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
