"""Connected components of an undirected graph, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def _hook(directed: DataFrame, keep) -> DataFrame:
    """Point what is kept of each node's neighbours, and the node, to the least of all of them.

    The least neighbour is pre-aggregated before the shuffle, and the join back has one row per
    node on its other side, so adaptive execution can split a node with very many neighbours.
    """
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = directed.join(least, "u")
    neighbours = joined.filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return neighbours.union(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for each node of the edges (a, b) of longs; the root is the least node reachable.

    Alternates hooking towards larger and towards smaller neighbours until nothing changes, which
    takes a number of rounds that grows with the logarithm of the longest chain. Each round is
    written to shared storage. Loops and repeated edges have no effect.
    """
    pairs = edges.filter(F.col("a") != F.col("b"))
    links = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = materialize(links, label), None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(_hook(both, F.col("v") > F.col("u")), label)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        links = materialize(_hook(down, F.lit(True)), label)
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
