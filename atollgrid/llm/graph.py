"""Connected components in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of an edge, the smallest node that it reaches.

    Alternating large-star and small-star rounds (Kiveris and others, 2014): each keeps at most as many edges as it
    got, and the rounds are few even for long chains. Each round is a written table; two rounds with the same edges, by
    their count and the sum and xor of their 64-bit hashes, end it. A hub's edges stay rows of a join whose other side has one row per node, so they can be split.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    e = written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: smaller neighbours, and the node itself, move to the smallest
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        h = F.xxhash64("u", "v")
        new = small.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
        free(e, large)
        e = small
        if new == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
