"""Connected components of an edge list, by alternating stars.

Every round is two joins over the edges: a large star ties each node's larger
neighbours to its smallest neighbour, a small star does the same for the
smaller ones, until each component is one star around its smallest node.
Smallest neighbours are partially aggregated before their shuffle, and written
before the join, so both join sides are plain exchanges and AQE can split the
centre of a large component. Rounds grow with the logarithm of the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import written
from gridwright.operators.sizing import materialize_measured

MAX_ROUNDS = 60


def _smallest(edges: DataFrame) -> DataFrame:
    return written(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "star-least")


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` (a > b): each node's larger neighbours meet its smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = both.where("b > a").join(_smallest(both), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return met.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` (a > b): a node and its smaller neighbours meet the smallest one."""
    least = _smallest(edges)
    met = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return met.unionByName(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, and that one has none."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``, where
    component is the smallest node reachable. Ids are long and not null;
    loops and repeated edges do no harm; no edges give no rows."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now, rows, _ = materialize_measured(
        edges.select(high.cast("bigint").alias("a"), low.cast("bigint").alias("b")).where("a != b").distinct(), name
    )
    for _ in range(MAX_ROUNDS):
        if not rows or _all_stars(now):
            break
        now, rows, _ = materialize_measured(_small_star(written(_large_star(now), name)), name)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
