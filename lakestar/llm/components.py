"""Connected components of a graph of links, by alternating stars.

Edges live in a table and never on the driver. Each round joins every node's
neighbours to their smallest (large star: the larger neighbours; small star:
the smaller ones) until no edge changes; the rounds grow with the logarithm of
the longest chain. Minima are combined on the map side, and the joins that
bring them back are plain equi-joins, so a node with very many neighbours is
split by adaptive execution instead of meeting one task. Edges are checkpointed
in the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple[int, int]:
    # a sum of longs would overflow beyond 2**24 edges
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)).cast("decimal(28,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is its smallest reachable node."""
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = checkpointed(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    before = _state(edges)
    while before[0]:
        # large star: every larger neighbour of a node points to the smallest of the neighbourhood
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node's smaller neighbours, and itself, point to the smallest of them
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = checkpointed(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
