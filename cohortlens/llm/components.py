"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the pairs (a, b); the root is the smallest node reachable.

    Large-star and small-star steps alternate until every node points to its
    root: in each, a node's neighbours are pointed to the smallest node around it.
    Nothing larger than the edges is made and the number of rounds grows with the
    logarithm of the longest chain. The smallest neighbour is found by a partial
    minimum and written, so that the join that follows has two plain inputs and
    Spark can split a node with very many neighbours.
    """
    pairs = materialise(_down(edges.select("a", "b")), name)
    before = None
    while True:
        both = pairs.select("a", "b").union(pairs.select("b", "a"))
        large = _star(both, name).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct(), name)
        small = _star(large, name)
        pairs = materialise(
            _down(small.select("b", "m").union(small.select("a", "m")).toDF("a", "b")), name
        )
        # a forest of stars comes back unchanged; one row of sums shows it
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(pairs.select("b", "b")).distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Distinct pairs with the larger node first, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, name: str) -> DataFrame:
    """The edges with the smallest node at or beside a as ``m``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return edges.join(materialise(least, name), "a")
