"""Connected components of a link table by alternating large-star and small-star contraction.

Every round is two grouped minima (combined before the shuffle) and two joins whose skewed sides
adaptive execution may split; the links of a round are written to the shared folder, so no round
depends on the lineage of the one before. Nothing but two sums per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(arcs: DataFrame) -> DataFrame:
    """``arcs`` (u, v), each node with its own arc (u, u) implied: (v, smallest of u's neighbours
    and u), for every v next to u."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return arcs.join(least, arcs.u == least.w).select("u", "v", "m")


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b), undirected, of any orderable type: rows (node, component) for all nodes
    in links, component being the smallest node reachable. Repeated links, loops and links in
    both directions do no harm; an empty table gives an empty result."""
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        s = _star(large)
        small = s.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(s.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u != v").distinct(), "links")
        # A star forest is a fixed point: every node hangs on its component's smallest node.
        # The hashes' sum (as decimal: no overflow) and the count tell whether anything moved.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
