"""Distributed connected components by alternating large-star and small-star steps.

Only DataFrame operations. Ids may be of any orderable type. Each round is two
joins of the edges with per-node minima; the minima are aggregates (combined
before the shuffle), and the joins leave their exchange to AQE's skew splitting,
so a node that holds a third of all edges does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of node and neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    out = both.join(low, both.a == low.node).filter("b > a")
    return out.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these. Edges have a > b."""
    low = edges.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "node")
    joined = edges.join(low, edges.a == low.node).filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return joined.union(low.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    ``edges`` has two columns (names are free). Null ends and loops are ignored;
    repeated edges count once; no edges give an empty result. The number of
    rounds grows with the logarithm of the longest chain; ``max_rounds`` only
    guards against a fault, and is an error, never a cut.
    """
    x, y = edges.columns[:2]
    pairs = edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter(
        F.col(x).isNotNull() & F.col(y).isNotNull() & (F.col(x) != F.col(y))
    )
    now = materialize(pairs.distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        now = materialize(_small_star(_large_star(now)), "stars")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )


def _mark(edges: DataFrame) -> tuple:
    """Number and checksums of the edges: equal marks of two rounds mean equal edges."""
    row = edges.select(F.xxhash64("a", "b").alias("h"), F.xxhash64("b", "a").alias("g")).agg(
        F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(20,0)")), F.sum(F.col("g").cast("decimal(20,0)"))
    ).first()
    return tuple(row)
