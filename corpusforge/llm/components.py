"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the links; nothing but a count and a checksum of the links
reaches the driver. Rounds needed grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import discard, materialize


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 998_244_353)).first()
    return tuple(row)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node that has a link; root is the smallest node reachable.

    Self links and rows with a null end are ignored, repeated links count once, an empty table gives an empty
    result. Nodes are longs.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    now = materialize(links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    seen = _digest(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, seen = seen, _digest(after)
        discard(now)
        now = after
        if before == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
