"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _stars(edges: DataFrame) -> DataFrame:
    """One round: hang every node's larger neighbours, then its smaller ones, on the smallest.

    ``edges`` has (u, v) with u > v. Both halves pre-aggregate the minimum per
    node, so that a hub is a skewed join side (split by AQE), never one group.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u <> v").distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                          F.col("m").alias("v")).where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every node that has an edge; component is its smallest node.

    ``edges`` has two columns of ids; direction, repeats and self-loops do not
    matter, rows with a null end are ignored. The rounds end when the edges no
    longer change, judged by their number and a sum of hashes; only those two
    numbers reach the driver.
    """
    a, b = edges.columns[:2]
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    state, e = None, written(e, "edges")
    for _ in range(max_rounds):
        stars = written(_stars(e), "stars")
        discard(e)
        e = stars
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
