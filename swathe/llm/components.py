"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every end of a link; the root is the smallest node reachable.

    ``links`` has two columns ``a``, ``b`` of one orderable type. Links with a
    null end, loops and repeated links count for nothing. Each round hangs all
    neighbours of a node on its smallest one, first the larger neighbours and
    then the smaller, and is written to the shared folder; the rounds needed
    grow with the logarithm of the longest chain. A node with many neighbours
    takes part as many rows, never as one list.
    """
    clean = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(clean, "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = stored(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
    return tuple(row)
