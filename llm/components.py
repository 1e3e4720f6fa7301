"""Connected components of very large graphs by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long): the smallest node reachable.

    Each round ties every node's larger neighbours to its smallest one, then its smaller ones; all
    components are stars around their smallest node after a number of rounds that grows with the
    logarithm of their size. Rounds are written to the shared folder. Joins on a node with very
    many neighbours are left to adaptive skew handling.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    last = _print(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "small-star")
        now = _print(edges)
        if now == last:
            break
        last = now
    ends = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(ends)
