"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


#: A node of more edges than this is a hub.
HUB_EDGES = 100_000
#: Hubs at most: a hub has more than a ``HUBS``-th of all edge ends, so there can't be more of them.
HUBS = 1_000


def _with_least(edges: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """``edges`` (a, b) with the ``m`` of their ``a`` in ``least`` (a, m, n), n being the number of edges of a.

    The edges of hubs are not shuffled: hubs are few by definition (see ``HUBS``) and their rows are broadcast; the
    edges of all other nodes are merge-joined, none of which has more than a small share of them.
    """
    hub = F.col("n") > max(ends / HUBS, HUB_EDGES)
    rest = least.where(~hub).select("a", "m").hint("merge")
    if least.where(hub).isEmpty():
        return edges.join(rest, "a")
    hubs = F.broadcast(least.where(hub).select("a", "m"))
    return edges.join(hubs, "a").unionByName(edges.join(hubs, "a", "left_anti").join(rest, "a"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    found = _with_least(both, written(counted, "components-least"), 2 * n)
    return found.where("b > a and b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "components-least")
    moved = _with_least(edges, least, edges.count()).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) as decimal(38, 0)))")
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; a > b): root is the component's smallest node.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs one
    round; only a count and two checksums reach the driver. The number of rounds grows with the
    logarithm of the graph's diameter.
    """
    edges = written(edges.select("a", "b"), "components")
    seen = _digest(edges)
    while seen[0]:
        edges = written(_small_star(written(_large_star(edges, seen[0]), "components")), "components")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
