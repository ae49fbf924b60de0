"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from moodloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "v")
    # Edges run from the larger node u to the smaller v, so these are v's larger neighbours.
    return edges.join(least, "v").select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its smallest node.

    The minima combine before the shuffle, and a hub is the larger side of a join with one
    row for each node, which Spark can split. Only a count and a checksum reach the driver. Loops
    (a = a) and nulls are ignored. Every round is written, so a lost executor costs one round.
    """
    state = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state, before = state.where("a <> b"), None
    while True:
        # The count and the checksum come with the write.
        seen = Observation()
        stars = _small_star(_large_star(state)).observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("sum")
        )
        state = materialize(stars, "stars")
        if seen.get == before:
            break
        before = seen.get
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(state.select(F.col("u").alias("node"), F.col("v").alias("component")))
