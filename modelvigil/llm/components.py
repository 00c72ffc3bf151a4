"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.session import materialise


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``links`` (``u``, ``v``, longs).

    Each round hangs the larger neighbours of a node, then its smaller ones, below the smallest; the number of
    rounds grows with the logarithm of a component's size. Minima are combined before they are shuffled, so a node
    with very many links is no hot group, and the joins on a node may be split by adaptive execution. Lineage is
    cut by a checkpoint in the shared folder after each round. Links with a null end or from a node to itself are
    left out.
    """
    ends = links.where(F.col("u") != F.col("v"))
    stars = materialise(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        after = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before or after[0] == 0:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = after
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u")
        stars = materialise(
            small.where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(lowest.select("u", F.col("low").alias("v")))
            .distinct()
        )
    raise RuntimeError(f"components did not settle in {rounds} rounds")
