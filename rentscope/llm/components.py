"""Connected components of an edge table, as alternating star rounds.

Edges stay a Spark table throughout: a large-star round links every larger
neighbour to the smallest one around, a small-star round does so for the
smaller ones.  The edge count never grows, no adjacency list is gathered, and
each round is written to the shared folder (lineage cut, executor loss costs
one round at most).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path


def _min_of(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _min_of(both).select("u", F.least("u", "m").alias("m"))
    large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    low = _min_of(large)
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of an edge, the smallest node it reaches.

    ``edges`` has columns ``u``, ``v`` (bigint); loops and repeats are
    allowed; an empty table gives an empty result.  Nodes without an edge
    are not listed."""
    spark = edges.sparkSession
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen, old_path = None, None
    while True:
        path = scratch_path(spark, "stars")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if old_path is not None:
            drop_path(spark, old_path)
        if state == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen, old_path = state, path
        now = _round(now)
