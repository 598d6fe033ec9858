"""Connected components of an edge table, without gathering it anywhere.

Alternating large-star and small-star rounds: every node hangs its larger
neighbours, then its smaller ones, below the smallest node it knows, until each
component is a star. Every round is two joins over the edges that are left, and
is written out, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.stored import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    above = both.filter("b > a").join(least, "a")
    return above.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b != least").select(F.col("b").alias("a"), "least")
    return least.union(moved).toDF("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges(a, b)``; component is its smallest node.

    Edges with a null end and loops are ignored; repeated edges count once. No
    edges give no rows.
    """
    edges = edges.select("a", "b").filter("a != b")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)).distinct(), "edges")
        if before is not None:
            discard(before)
        before = edges
        # Done when every node leads to one other, and that one leads nowhere.
        up = edges.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        inner = up.select(F.col("a").alias("inner"))
        left = up.join(inner, F.col("high") == F.col("inner"), "left")
        if left.filter("low != high or inner is not null").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
