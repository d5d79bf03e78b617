"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import stored


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows, itself included."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(_least(both).withColumn("m", F.least("u", "m")), "least")
    return both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them. Every link has u > v."""
    least = stored(_least(links), "least")
    others = links.join(least.hint("merge"), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def labels(links: DataFrame) -> DataFrame:
    """u, v of every node that is linked to a smaller one, v being the smallest node of its component.

    ``links`` has two columns u and v of one type; order, repetition and links to oneself do not matter.
    Minima are combined before each shuffle. They are written before they meet the links, so that both sides
    of the join are plain shuffles and adaptive execution splits a hub that fills a partition.
    """
    current = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stored(current.distinct(), "links")
    mark = _mark(current)
    while True:
        current = stored(_small_star(stored(_large_star(current), "links")), "links")
        following = _mark(current)
        if following == mark:
            return current
        mark = following
