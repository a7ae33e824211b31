"""Connected components by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelab.llm.skew import join_unique
from ratelab.shared import cut_lineage


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of an edge table, component the smallest node reachable.

    Each round hangs larger neighbours onto the smallest neighbour of a node,
    then does the same with its smaller ones, until only stars are left. Rounds
    grow with the logarithm of the longest chain. A node with very many links
    is reduced by partial minima; the joins meet one row per node, so a hot
    node only makes one side skewed, which adaptive execution splits. Rows with
    a null end and self-links are left out.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    whole = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    stars = cut_lineage(links.where(whole).select(u, v).distinct())
    seen = _state(stars)
    while seen[0]:
        low = stars.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = join_unique(stars, low, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        large = cut_lineage(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = join_unique(large, low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(hung.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = _state(stars)
        if now == seen:
            break
        seen = now
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(stars.select("v", "v").distinct())


def _state(stars):
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
