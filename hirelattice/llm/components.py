"""Connected components of an undirected graph, as rounds of joins and aggregates.

Each round hangs every node on the smallest node it has seen, first from the larger side and then from the
smaller side of its edges; the number of rounds grows with the logarithm of the longest path. A node with very
many edges is reduced by a partial aggregate, and its join is split by adaptive execution. Each round is written to
the shared folder, so a lost executor costs no earlier round; the driver sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.session import materialise


def _signature(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs -> (node, component) for every node of an edge; component is its smallest node.

    Loops, repeated and reversed edges are allowed; an empty graph gives no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = materialise(links, "edges")
    before = _signature(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialise(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
        after = _signature(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
