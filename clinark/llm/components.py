"""Connected components of a distributed edge list, by alternating large and small stars.

Each step is a per-vertex minimum (combined per task before its shuffle) and a join back,
so no vertex's neighbours are ever gathered; a hot vertex is split by the adaptive
planner's skew join. The edge list is written to the shared folder after each pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b), a <> b: label is its component's smallest node."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    mark = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
