"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; ``edges`` has long columns u and v, u != v.

    Each round writes a table, so a lost executor costs one round. Rounds grow with the
    logarithm of the longest path. Minima are combined before the shuffle, and the joins
    are plain ones that adaptive execution splits at a hot root.
    """
    edges, before = stored(edges.distinct(), "edges"), None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if seen == before or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = seen
        edges = stored(_small_star(_large_star(edges)), "edges")
