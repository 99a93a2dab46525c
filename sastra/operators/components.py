"""Connected components of an undirected edge table, by alternating star contraction.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every round is two
aggregations and two joins on the node key; no node's neighbourhood is gathered in one row, so a
component may hold any share of all nodes. Rounds are staged, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.plans.stage import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(directed: DataFrame) -> DataFrame:
    """Links each neighbour v of u to the least of u and its neighbours in `directed`."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least, "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node id of each node's component, for nodes that have an edge.

    Loops and repeated edges do no harm; nulls are dropped; no edges give no rows.
    """
    current = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: neighbours above u move to the least of u's neighbourhood
        large = _star(_both(current)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: neighbours below u, and u itself, move to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = _star(down)
        small = least.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        current = stage(small, "star")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = current.select(F.col("v").alias("u"), "v").distinct()
    return current.union(roots).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
