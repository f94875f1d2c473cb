"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimeter.llm.shared import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour is tied to the smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The node and its smaller neighbours are tied to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest node reachable, for all nodes that are not their own label.

    ``edges`` has long columns u and v. Each round is written, so no lineage grows; the
    number of rounds grows with the logarithm of the component size. No component is
    gathered anywhere: hot centres meet in sums with map-side combination and in joins.
    """

    def state(rows: DataFrame) -> tuple:
        return rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    current = scratch.store(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = state(current)
    while before[0]:
        larger = _large_star(current)
        following = scratch.store(_small_star(larger), "edges")
        scratch.drop(current)
        current, after = following, state(following)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("label"))
