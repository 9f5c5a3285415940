"""Connected components of an edge table by repeated contraction.

Every node moves to its smallest neighbour (or itself), edges are rewritten and
repeated ones dropped, until none is left. Identifiers are digests, i.e. in random
order, so a constant share of the nodes is expected to go in each round. Rounds are
stored, which cuts the lineage; nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root), root the same for all of a component."""
    live = stored(edges.filter("a <> b").distinct(), "components_edges")
    nodes = live.select(F.col("a").alias("node")).unionByName(live.select(F.col("b").alias("node"))).distinct()
    mapping = stored(nodes.withColumn("root", F.col("node")), "components_nodes")
    while not live.isEmpty():
        ends = live.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(live.select(F.col("b").alias("x"), F.col("a").alias("y")))
        smallest = ends.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("to"))
        smallest = stored(smallest, "components_moves")
        left = smallest.select(F.col("x").alias("root"), F.col("to").alias("_to"))
        mapping = mapping.join(left, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
        mapping = stored(mapping, "components_nodes")
        ma = smallest.select(F.col("x").alias("a"), F.col("to").alias("_a"))
        mb = smallest.select(F.col("x").alias("b"), F.col("to").alias("_b"))
        moved = live.join(ma, "a").join(mb, "b").filter("_a <> _b")
        moved = moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        live = stored(moved, "components_edges")
    return mapping
