"""Connected components of an edge table as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.session import ensure_checkpoint_dir


def _star(edges: DataFrame, keep) -> DataFrame:
    """Link every node's neighbours to the least of them and itself. The least
    is a map-side aggregate and the links a join, so that a node with very many
    neighbours is never gathered (skewed joins are split at run time)."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; component is its least node.

    Alternating large-star and small-star rounds (each halves path lengths, so
    their number is logarithmic); every round is checkpointed in the shared
    folder and only a count and two checksums reach the driver. Null ends and
    self-links are ignored; without edges there are no rows."""
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    was = _mark(e)
    while was[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).distinct()
        # small star: neighbours not above the node, and the node itself
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = _mark(e)
        if now == was:
            break
        was = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
