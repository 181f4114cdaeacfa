"""Connected components of a graph given by its edges.

Alternating large-star and small-star steps: every step replaces the edges of a
node by edges to its least neighbour, so the number of edges never grows and long
chains halve. A step is a minimum by key (combined in the tasks) and a join that
the planner may split by skew; neighbours of one node are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultloom.sources.scratch import scratch_folder, written

MOST_STEPS = 200


def _large_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """Larger neighbours of each node move to the node's least neighbour."""
    both = edges.select("a", "b").unionByName(edges.selectExpr("b AS a", "a AS b"))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), folder, f"{name}l")
    return (both.join(least, "a").filter("b > a").selectExpr("b AS a", "least AS b")
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the least of them."""
    down = written(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b"), folder, f"{name}d")
    least = written(down.groupBy("a").agg(F.min("b").alias("least")), folder, f"{name}s")
    moved = down.join(least, "a").filter("b <> least").selectExpr("b AS a", "least AS b")
    return moved.unionByName(least.selectExpr("a", "least AS b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge; root is the least node reachable.

    ``edges`` has two columns a and b of one comparable type, in either direction,
    repeated or not; a = b is ignored. No edges give no rows.
    """
    folder = scratch_folder(edges.sparkSession)
    now = written(edges.filter("a <> b").distinct(), folder, "edges")
    seen = None
    for step in range(MOST_STEPS):
        now = written(
            _small_star(_large_star(now, folder, f"{step}"), folder, f"{step}"), folder, f"{step}")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.selectExpr("a AS node", "b AS root").unionByName(
                now.selectExpr("b AS node", "b AS root").distinct())
        seen = mark
    raise RuntimeError(f"no fixed point after {MOST_STEPS} steps")
