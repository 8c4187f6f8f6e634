"""Connected components of a table of links, by alternating star contraction.

Each round hangs every node's larger neighbours, then its smaller ones, on the
smallest of them; after about log n rounds each component is a star around its
smallest node. Links stay in written tables; the driver sees only their count and sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.joins import join_per_key
from daybook.sources.scratch import saved


def _both_ways(links: DataFrame) -> DataFrame:
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.unionAll(back)


def _hung(neighbours: DataFrame) -> DataFrame:
    """Every neighbour ``b`` of ``a``, and ``a`` itself, linked to the smallest of them."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return join_per_key(neighbours, least, ["a"], "inner")


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, root`` for every node in ``links`` (columns ``a, b``): root is the smallest reachable."""
    larger = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = saved(links.select(*larger).where("a <> b").distinct(), f"{folder}/links-0")
    mark, n = None, 0
    while True:
        hung = _hung(_both_ways(now)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        hung = saved(hung.where("a <> b").distinct(), f"{folder}/large-{n}")
        small = _hung(hung)
        pairs = small.select("b", "least").unionAll(small.select("a", "least")).toDF("a", "b")
        n += 1
        now = saved(pairs.where("a <> b").distinct(), f"{folder}/links-{n}")
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if was == mark:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
