"""Connected components of a distributed list of links, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; ``component`` is the smallest node it reaches.

    Alternates the two star steps: each node hands its larger neighbours to its smallest one, then its
    smaller ones. Node degrees shrink to stars in a logarithmic number of rounds. Each round is written
    to the shared folder, so a lost executor costs one round. Nulls and loops are dropped.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = materialise(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    if pairs.isEmpty():
        return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    for _ in range(rounds):
        pairs = materialise(_small_star(_large_star(pairs)), "links")
        now = pairs.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest neighbour."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
