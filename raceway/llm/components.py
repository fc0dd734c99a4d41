"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from raceway.llm.common import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    inner = down.join(least, "a").filter("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return inner.unionByName(least.withColumnRenamed("_m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the smallest node reachable.

    Edges have two different, non-NULL ends. Each round is stored in the shared folder; nothing
    but a checksum reaches the driver. Rounds grow with the logarithm of the longest path. The folders
    of all rounds but the last are removed.
    """
    spark, made, seen = edges.sparkSession, [], None
    edges = staged(edges.select("a", "b").distinct(), "edges", made)
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
        older, made = made, []
        edges = staged(_small_star(_large_star(edges)), "edges", made)
        discard(spark, older)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
