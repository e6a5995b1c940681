"""Connected components of a link table by alternating large and small stars.

Every round moves each node's neighbours to the smallest one known; the number of rounds grows
with the logarithm of the longest chain. Minima are combined before the shuffle and joined back, so
that a node with very many links is split by adaptive execution; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every linked node; the label is the smallest node of its component.

    Links may repeat and point either way; self links and links with a null end are no links.
    """
    u, v = F.col(a), F.col(b)
    edges = materialise(links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    seen = _digest(edges)
    while True:
        # large star: everything larger than u among its neighbours moves to the smallest of them
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        # small star: u and its smaller neighbours all move to the smallest
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(small_least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialise(moved, "links")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
