"""Request bodies holding a bounded number of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import batch_number, global_row_number


def batch_payloads(
    df: DataFrame,
    key: str,
    record: Column,
    root: str,
    size: int = 50,
    shards: int | None = None,
) -> DataFrame:
    """JSON bodies ``{root: [record, ...]}`` of at most ``size`` records.

    All rows are numbered over hash buckets and make exactly ``ceil(rows / size)`` bodies, for one more
    pass over the keys. With ``shards`` the rows of each of so many hash shards are cut on their own
    instead: one pass less, and each shard may end in a short batch. ``key`` must be unique and not null.
    """
    if shards is None:
        placed = global_row_number(df, key, out="_rn").withColumns(
            {"shard": F.lit(0), "batch_no": F.floor(F.col("_rn") / size).cast("bigint")}
        )
    else:
        placed = batch_number(df, key, size, shards)
    records = F.transform(
        F.array_sort(F.collect_list(F.struct("_rn", record.alias("record")))), lambda x: x["record"]
    )
    return (
        placed.groupBy("shard", "batch_no")
        .agg(F.count("*").alias("records"), records.alias("_records"))
        .select(
            "shard",
            "batch_no",
            "records",
            F.to_json(F.struct(F.col("_records").alias(root)), {"ignoreNullFields": "false"}).alias("payload"),
        )
    )
