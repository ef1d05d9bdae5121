"""Connected components of an edge table by alternating large-star and small-star steps.

Edges are first contracted to spanning stars inside each Arrow batch, so a dense group enters the
loop as few edges.  Minima are grouped aggregates (partial before the shuffle) and are joined back, those
of hubs by a broadcast of bounded size; no neighbour list is ever built.  Each round is written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

HUBS = 1000  # a node with more than a thousandth of the edges is a hub; at most 4 * HUBS rows are broadcast


def spanning_stars(pairs) -> dict:
    """node -> smallest node of its component, for the nodes of ``pairs`` (an iterable of tuples)."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


def _contract(batches):
    for b in batches:
        stars = spanning_stars(zip(b["u"].to_pylist(), b["v"].to_pylist()))
        out = [(n, r) for n, r in stars.items() if n != r]
        if out:
            u, v = zip(*out)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _with_least(pairs: DataFrame, hub: int) -> DataFrame:
    """Each (u, v) with ``m``, the least of all v of its u.

    A node with more than ``hub`` pairs would put them all into one task of a shuffle join.  Hubs are
    few (at most pairs / ``hub``) and are broadcast; their pairs stay where they are.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
    tagged = pairs.join(F.broadcast(least.filter(F.col("d") > hub).select("u", "m")), "u", "left")
    rest = least.filter(F.col("d") <= hub).select("u", "m")
    return tagged.filter("m IS NOT NULL").unionAll(tagged.filter("m IS NULL").select("u", "v").join(rest, "u"))


def _large_star(e: DataFrame, hub: int) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, hub).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(e: DataFrame, hub: int) -> DataFrame:
    pairs = _with_least(e, hub)
    return pairs.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                        F.col("m").alias("v")).unionAll(pairs.select("u", F.col("m").alias("v"))).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    """Does every edge lead from a leaf with no other edge to a node that is no leaf?"""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("out")).unionAll(e.select("v", F.lit(0)))
    nodes = ends.groupBy("n").agg(F.sum("out").alias("leaves"), F.count("*").alias("all"))
    return nodes.filter("leaves > 1 OR (leaves = 1 AND `all` > 1)").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; ``component`` is the smallest LONG node reachable."""
    e = (edges.filter(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .mapInArrow(_contract, "u long, v long").distinct())
    e = cut_lineage(e, "edges")
    while not _is_star_forest(e):
        hub = max(64, e.count() // HUBS)
        e = cut_lineage(_small_star(_large_star(e, hub), hub), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
