"""Connected components of links, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.tables import dropped, settled


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node it reaches) of every node of links (a, b).

    Alternates the large-star and small-star steps of Kiveris et al. (2014) on written tables
    until nothing changes; ``scratch`` of the result is the last of them. Each step is a partial aggregate and a join back to the written
    edges, so a node with very many links is split by adaptive execution.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = settled(links.where("a <> b").select(high, low).distinct(), "edges")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settled(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "stars")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large, "edges")
        dropped(edges, least)
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = settled(small, "edges")
        dropped(large, least)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    found.scratch = edges.scratch
    return found
