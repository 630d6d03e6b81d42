"""Connected components of a table of links by alternating large and small stars.

Each round moves every link towards the smallest neighbour of one of its ends,
until all links are stars around the smallest id of their component. Links and
minima stay in tables; minima are written before they are joined, so both sides
of a join are shuffled and a hot node's rows can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop


def _star(links: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """Links (u, v), u > v, moved to the smallest of each node's neighbours and itself; the table they come from."""
    both = links.select("u", "v")
    if large:
        both = both.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
    met = both.join(least, "u")
    if large:
        moved = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select("v", "m").union(least.select("u", "m")).toDF("u", "v")
    return moved.filter(F.col("u") != F.col("v")).distinct(), least


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id of the links (a, b)."""
    now = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = cut(now, "links")
    while True:
        by_large, large_minima = _star(now, True)
        by_small, small_minima = _star(by_large, False)
        nxt = cut(by_small, "links")
        drop(large_minima, small_minima)
        # nothing moved if no link is new and none is gone
        sums = [t.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first() for t in (now, nxt)]
        drop(now)
        now = nxt
        if sums[0] == sums[1]:
            break
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("id"), "component")).distinct()
