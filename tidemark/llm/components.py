"""Connected components by alternating star rounds over stored edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def _signature(edges: DataFrame):
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "low"))).first()
    return row[0], row[1]


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    ``links`` are undirected.  Every round hangs the larger neighbours of a node
    on its smallest one, then the smaller ones, until nothing moves; the rounds
    grow with the logarithm of the longest chain.  Only minima per node are
    grouped, so a node with very many neighbours is no burden, and each round is
    a stored table, so a lost executor repeats one round at most.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("low")
    )
    edges = stage(edges.distinct(), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
        lowest = both.groupBy("node").agg(F.least(F.min("low"), F.col("node")).alias("root"))
        hung = (
            both.where(F.col("low") > F.col("node"))
            .join(lowest, "node")
            .select(F.col("low").alias("node"), F.col("root").alias("low"))
        )
        edges = stage(hung.distinct(), "links")
        lowest = edges.groupBy("node").agg(F.min("low").alias("root"))
        moved = (
            edges.join(lowest, "node")
            .where(F.col("low") != F.col("root"))
            .select(F.col("low").alias("node"), F.col("root").alias("low"))
            .unionAll(lowest.select("node", F.col("root").alias("low")))
        )
        edges = stage(moved.distinct(), "links")
        now = _signature(edges)
        if now == before:
            break
        before = now
    return edges.select("node", F.col("low").alias("root"))
