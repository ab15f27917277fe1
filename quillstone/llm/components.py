"""Connected components of an edge table, by alternating star contraction.

Every round is two aggregations by minimum and two joins; nothing is collected but a row count and a
hash that tell when the edges no longer change. Hubs are pre-aggregated before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that occurs in edges (u, v); root is the component's least node."""
    now = checkpoint(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == state or row[0] == 0:
            break
        state = tuple(row)
        now = checkpoint(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
