"""Exact row numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import hash_slot

BUCKETS = 65_536


def global_row_number(
    df: DataFrame, key: str, out: str = "row_number", seed: str = "", total: str | None = None
) -> DataFrame:
    """Number all rows 0..n-1 in the order of a seeded hash of ``key``; optionally add n.

    Rows are numbered inside hash buckets, and every bucket starts where the ones before it end.
    The bucket sizes form a table of at most ``BUCKETS`` rows, which is why it may be summed in
    one task and broadcast. Keys must be unique for the numbering to be repeatable.
    """
    hashed = df.withColumn("_bucket", hash_slot(F.col(key), BUCKETS, seed))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_start"),
            F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
        )
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(key)
    numbered = hashed.join(F.broadcast(starts), "_bucket").withColumn(
        out, F.col("_start") + F.row_number().over(in_bucket) - 1
    )
    if total:
        numbered = numbered.withColumn(total, F.col("_total"))
    return numbered.drop("_bucket", "_start", "_total")


def batch_number(df: DataFrame, key: str, size: int, shards: int) -> DataFrame:
    """Add ``shard`` and ``batch_no``: runs of ``size`` rows inside every hash shard.

    Needs one shuffle. Only the last batch of a shard may be short.
    """
    in_shard: Column = F.row_number().over(Window.partitionBy("shard").orderBy(key))
    return (
        df.withColumn("shard", hash_slot(F.col(key), shards))
        .withColumn("_rn", in_shard - 1)
        .withColumn("batch_no", F.floor(F.col("_rn") / size).cast("bigint"))
    )
