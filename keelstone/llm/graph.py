"""Connected components of links in rounds of joins; nothing but counts comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(name, root) for every end of an edge (src, dst): root is the smallest end that can be reached.

    Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond"), each written
    to the shared checkpoint folder. A node that all others point to is combined before the shuffle by min(), so a large
    component is not one task's work.
    """
    edges = cut_lineage(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u != v").distinct())
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = cut_lineage(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    tops = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u", "left_anti").select("u", F.col("u").alias("root"))
    return roots.unionByName(tops).select(F.col("u").alias(name), "root")
