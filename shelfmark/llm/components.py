"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.words import store


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest reachable node) for every node with a link.

    ``links`` has long columns a and b. Alternating stars: each node's neighbours are
    joined to the smallest of them, larger and smaller ones in turn, until nothing changes;
    the number of rounds grows with the logarithm of the longest path. Every round is one
    aggregation and one join of narrow rows, which adaptive execution splits where a node
    has very many links.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = store(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        # Larger neighbours of each node go to the smallest of its neighbours and itself.
        paths = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = paths.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = paths.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Each node and its smaller neighbours go to the smallest of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = store(small, "links")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("u", "v") % 1000003).cast("long"))).first()
        if state == seen:
            break
        seen = state
    # Stable: every node but the smallest has one edge, to the smallest.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
