"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014) on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import landed


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(node, label)``: label is the smallest node of the component; isolated nodes are absent.

    Each step replaces edges by edges to a node's smallest neighbour, so a component becomes a star in O(log^2 n)
    steps. Minima are partial aggregates and the joins are plain equi-joins that AQE may split, so a hub does not
    land in one task. Only a row count and a checksum reach the driver. Every step is a table in the shared folder.
    """
    edges = landed(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = _signature(edges)
    while seen[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = landed(small, "edges")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
