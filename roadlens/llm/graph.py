"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import kept_table

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(``v``, ``root``) for every vertex of ``links`` (``a``, ``b``): root is
    the smallest vertex reachable. Each round relinks vertices to the least of
    their neighbours, by aggregates and joins; rounds grow with the logarithm
    of the longest path. Every round is a table in the shared folder."""
    edges = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("u <> v").distinct())
    edges = kept_table(edges, "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u <> v").distinct())
        edges = kept_table(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(
        edges.select("v", F.col("v").alias("root")).distinct())
