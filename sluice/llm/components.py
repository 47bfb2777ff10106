"""Connected components of a graph by alternating star contraction.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond") as joins and minima: no neighbour list is gathered, a
hot node's rows stay spread by map-side minima and the join's skew handling.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import materialize


def _minima(pairs):
    """Smallest neighbour of every node, or the node itself."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges):
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges):
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minima(down)
    rest = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is its smallest node.

    Nodes are longs; loops and repeated edges do no harm; no edges give no
    rows.  Every round is written to the shared folder, which cuts lineage.
    """
    edges = materialize(edges.where("u <> v").select("u", "v").distinct(), "star")
    state = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "star")
        now = _state(edges)
        if now == state:
            break
        state = now
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own)
