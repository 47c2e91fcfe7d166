"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.sources.scratch import discard, stored


def _stars(links: DataFrame, both_ways: bool) -> DataFrame:
    """Point the larger (or all smaller) neighbours of each node to its smallest neighbour."""
    if both_ways:
        sides = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        moved = sides.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("k")).select("v", "m")
        return moved.toDF("u", "v").distinct()
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    moved = links.join(least, F.col("u") == F.col("k")).where(F.col("v") != F.col("m")).select("v", "m")
    return moved.union(least).toDF("u", "v").distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has a link; the component is its smallest node.

    Each round is two joins and their aggregates over the links, kept in the
    shared scratch folder; the rounds grow with the logarithm of the longest
    chain. The driver sees one count and one checksum a round.
    """
    spark = links.sparkSession
    start = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    at, path = stored(start.distinct(), "components")
    seen = None
    while True:
        # every u is above its v, and stays so
        nxt, nxt_path = stored(_stars(_stars(at, True), False), "components")
        state = tuple(nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        discard(spark, path)
        at, path = nxt, nxt_path
        if state == seen:
            break
        seen = state
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
