"""Connected components of links between integer ids, by alternating large-star and small-star steps.

Each step is one pre-aggregated minimum by node and one join, so a node with very many links is
split like any skewed join key; no adjacency list is ever collected. Tables are cut from their
lineage by writing them to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of links (a, b): the smallest id it reaches. A node without
    links isn't in the result; links of a node with itself or null say nothing."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before, k = scratch.save(edges, f"{name}-0"), None, 0
    now = _checksum(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))  # all neighbours are smaller here
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        k += 1
        edges = scratch.save(small, f"{name}-{k}")
        before, now = now, _checksum(edges)
        scratch.drop(f"{name}-{k - 1}")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
