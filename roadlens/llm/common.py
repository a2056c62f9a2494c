"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.session import checkpoint_root, scratch_path, ship_package

__all__ = ["ascii_lower", "checkpoint_root", "grouped_rank", "kept_table", "read",
           "small_enough", "ship_package", "stable_hash"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` would also change other scripts."""
    return F.translate(text, UPPER, UPPER.lower())


def stable_hash(*cols: Column) -> Column:
    """60 bits of an md5, as a non-negative long: the same in every engine."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once: written to the shared checkpoint folder and read
    back. It survives lost executors and cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def grouped_rank(df: DataFrame, key: str, hashed: str, ties: list[str], rank: str,
                 rows_per_bucket: int = 50_000) -> DataFrame:
    """``df`` with ``rank``: the row's place from 0 among the rows of ``key``,
    ordered by ``hashed`` (a 60-bit hash) and ``ties``.

    A key may hold any share of the rows: its rows are split by the leading
    bits of the hash, counted per bucket, and only the bucket counts are summed
    along a key. No task sorts more than about one bucket of a key. ``key`` and
    ``hashed`` must not be null."""
    total = df.count()
    bits = max(0, math.ceil(math.log2(max(1, total / rows_per_bucket))))
    df = df.withColumn("__bucket", F.shiftright(F.col(hashed), 60 - bits))
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(key, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")))
              .drop("__n"))
    inside = Window.partitionBy(key, "__bucket").orderBy(hashed, *ties)
    return (df.withColumn("__at", F.row_number().over(inside))
            .join(starts, [key, "__bucket"])
            .withColumn(rank, F.col("__start") + F.col("__at") - 1)
            .drop("__bucket", "__start", "__at"))


#: Tables of ids up to this many rows (16 bytes each) are sent to every executor.
BROADCAST_ROWS = 1_000_000


def small_enough(ids: DataFrame) -> DataFrame:
    """``ids`` (a written table of one or a few narrow columns) with a
    broadcast hint if its rows are counted and few; beyond that the join
    shuffles both sides."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
