"""Connected components of a table of links, without gathering any component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable from it, for every node of ``links`` (a, b).

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every node is hung below the
    smallest of its neighbours until only stars remain. Each round is written to the shared folder.
    """
    edges = scratch.keep(_pairs(links.select("a", "b")), "edges-0")
    step = 0
    while True:
        # Large star: each larger neighbour of a node goes below the node's smallest neighbour.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("at"), F.least("a", "least").alias("least")
        )
        large = both.filter("b > a").join(least, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = _pairs(large)
        # Small star: each smaller neighbour of a node, and the node itself, go below the smallest.
        least = large.groupBy("b").agg(F.min("a").alias("least")).select(F.col("b").alias("at"), "least")
        small = large.join(least, F.col("b") == F.col("at"))
        small = small.select("a", F.col("least").alias("b")).union(least.select(F.col("at").alias("a"), F.col("least").alias("b")))
        step += 1
        after = scratch.keep(_pairs(small), f"edges-{step}")
        changed = after.exceptAll(edges).limit(1).count() or edges.exceptAll(after).limit(1).count()
        scratch.drop(f"edges-{step - 1}")
        edges = after
        if not changed:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _pairs(links: DataFrame) -> DataFrame:
    """Each link once, smaller node first, none to itself."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
