"""Connected components of a table of links, by alternating stars.

Large stars hang every larger neighbour of a node on the node's smallest
neighbour, small stars every smaller one; the links of a component end as one
star around its smallest member. Neither collects the neighbours of a node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import cut


def _print(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every linked node; the component is its smallest id."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    links = cut(links.filter(F.col(a) != F.col(b)).select(u, v).distinct())
    seen = _print(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        below = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut(below.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = _print(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
