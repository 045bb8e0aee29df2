"""Joins and lookups.

No side carries a broadcast hint: adaptive execution broadcasts a side once its measured size is
under the session's threshold, and otherwise runs a shuffled join whose skewed partitions it splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import latest_rows


def enrich_left(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows with the columns of ``dim``; unmatched rows keep nulls. The dim key is dropped."""
    keyed = dim.withColumnRenamed(dim_key, "_dim_key")
    return fact.join(keyed, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")


# A side of at most this many rows is sent to every executor. Its rows should be small.
BROADCAST_ROWS = 100_000


def join_measured(
    big: DataFrame, small: DataFrame, key: str, how: str = "inner", rows: int = BROADCAST_ROWS, parts: int = 16
) -> DataFrame:
    """Join on a key with few values, whose rows must not be gathered by it.

    ``small`` is counted up to ``rows``; keep it in a table first, as it is read twice. Up to that size it is
    broadcast and ``big`` stays where it is. A larger one is copied ``parts`` times and each of the big side's keys
    is split by a hash of the row, so that a key with a third of all rows is worked on by as many tasks. ``how`` is
    inner or left; null keys match nothing.
    """
    if small.limit(rows + 1).count() <= rows:
        return big.join(F.broadcast(small), key, how)
    split = big.withColumn("_part", F.pmod(F.xxhash64(*big.columns), F.lit(parts)))
    copies = small.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return split.join(copies, [key, "_part"], how).drop("_part")


def join_id_and_tag(
    left: DataFrame, jobs: DataFrame, id_col: str, job_id_col: str, tag_col: str = "matched_tag"
) -> DataFrame:
    """Rows whose id meets a job's id and whose tag equals the job's mandatory tag."""
    keyed = jobs.withColumnsRenamed({job_id_col: "_job_id", "mandatory_include_tags": "_job_tag"})
    return left.join(
        keyed, (F.col(id_col) == F.col("_job_id")) & (F.col(tag_col) == F.col("_job_tag"))
    ).drop("_job_id", "_job_tag")


def dedupe_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row per key, found by its order alone before the row itself is read."""
    return latest_rows(df, keys, [order])


def one_per_key(table: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """A lookup table with one row per key that is not null.

    Of a key's rows the last by ``order`` counts. Without an order the table may repeat rows, but a key with
    different rows is an error when the lookup runs: which of them counts is not for chance to say.
    """
    known = table.where(F.col(key).isNotNull())
    if order:
        return latest_rows(known, [key], [order])
    rest = [c for c in table.columns if c != key]
    if not rest:
        return known.distinct()
    row = F.struct(*rest)
    seen = known.groupBy(key).agg(F.min(row).alias("_a"), F.max(row).alias("_b"))
    text = F.concat(F.lit(f"lookup table has different rows for {key} = "), F.col(key).cast("string"), F.lit("; name its order column"))
    checked = F.when(F.col("_a").eqNullSafe(F.col("_b")), F.col("_a")).otherwise(F.raise_error(text))
    return seen.select(key, checked.alias("_row")).select(key, "_row.*")


def map_lookup(
    df: DataFrame,
    key: str,
    table: DataFrame,
    table_key: str,
    table_value: str,
    out: str,
    default: Column,
    order: str | None = None,
) -> DataFrame:
    """Value of a lookup table, or ``default`` where it is missing or empty.

    A lookup never adds rows: of a repeated key the last row by ``order`` counts, see ``one_per_key``.
    """
    columns = list(dict.fromkeys([table_key, table_value, *([order] if order else [])]))
    known = one_per_key(table.select(*columns), table_key, order).select(
        F.col(table_key).alias("_k"), F.col(table_value).alias("_v")
    )
    value = F.when(F.coalesce(F.col("_v"), F.lit("")) != "", F.col("_v")).otherwise(default)
    return df.join(known, F.col(key) == F.col("_k"), "left").withColumn(out, value).drop("_k", "_v")


def platform_channel(platform: str = "platform", channel: str = "channel") -> Column:
    return F.concat(F.col(platform), F.lit(" - "), F.col(channel))


def tracker_lookup(requests: DataFrame, trackers: DataFrame, order: str | None = None) -> DataFrame:
    """Android and iOS tracker ids of ``platform - channel``, null when unknown.

    Of a name that ``trackers`` repeats, the last row by ``order`` counts, see ``one_per_key``.
    """
    columns = ["platform_channel", "android", "ios", *([order] if order else [])]
    known = one_per_key(trackers.select(*columns), "platform_channel", order).select(
        F.col("platform_channel").alias("_pc"), F.col("android").alias("android_id"), F.col("ios").alias("ios_id")
    )
    return requests.join(known, platform_channel() == F.col("_pc"), "left").drop("_pc")


def default_campaign(requests: DataFrame, defaults: DataFrame, order: str | None = None) -> DataFrame:
    """Fill campaign, adgroup and creative from the defaults of ``platform - channel``, else ``''``.

    Of a name that ``defaults`` repeats, the last row by ``order`` counts, see ``one_per_key``.
    """
    fields = ["campaign", "adgroup", "creative"]
    columns = ["platform_channel", *fields, *([order] if order else [])]
    known = one_per_key(defaults.select(*columns), "platform_channel", order).select(
        F.col("platform_channel").alias("_pc"), *[F.col(f).alias(f"_{f}") for f in fields]
    )
    return (
        requests.join(known, platform_channel() == F.col("_pc"), "left")
        .withColumns({f: F.coalesce(F.col(f), F.col(f"_{f}"), F.lit("")) for f in fields})
        .drop("_pc", *[f"_{f}" for f in fields])
    )


def row_by_id(
    feed: DataFrame, requests: DataFrame, feed_id: str, request_id: str, row_col: str = "row_no"
) -> DataFrame:
    """Attach the last feed row with the requested id; ``found`` tells whether there is one."""
    latest = dedupe_last(feed, [feed_id], row_col)
    clash = set(requests.columns) & set(latest.columns) - {feed_id}
    if clash or feed_id in requests.columns and feed_id != request_id:
        raise ValueError(f"columns on both sides: {sorted(clash) or feed_id}")
    latest = latest.withColumnRenamed(feed_id, "_id").withColumn("_found", F.lit(True))
    return (
        requests.join(latest, F.col(request_id) == F.col("_id"), "left")
        .withColumn("found", F.coalesce(F.col("_found"), F.lit(False)))
        .drop("_id", "_found")
    )


def suppress(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """Rows of users that are not in ``ids``."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(col)), col, "left_anti")
