"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour or itself."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is the
    smallest node reachable, itself included.

    Self loops and edges with a null end say nothing and are dropped.  Each
    round writes its edges to the checkpoint folder; rounds are logarithmic in
    the longest path.  A hub's rows meet only in partial aggregates and in
    joins that Spark may split.
    """
    now = materialise(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        now = materialise(_small_star(_large_star(now)), name)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
