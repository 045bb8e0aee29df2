"""Grouped sums, counts and latest values. All combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import drop_null_dims, money_sum, sum_or_zero
from .ordering import latest_rows


def sum_by(df: DataFrame, dims: list[str], metrics: dict[str, str]) -> DataFrame:
    """Sum of metric columns by dims, under new names; null dims form no group."""
    return (
        drop_null_dims(df, dims)
        .groupBy(*dims)
        .agg(*[sum_or_zero(F.col(c)).alias(name) for c, name in metrics.items()])
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Event count by date and event name."""
    return sum_by(events, ["date_dt", "eventName"], {"eventCount": "eventCount"})


def organic_daily(organic: DataFrame, prefix: str = "b2b_organic_") -> DataFrame:
    """Organic impressions and clicks by date."""
    return sum_by(organic, ["date_dt"], {c: prefix + c for c in ("impressions", "clicks")})


def paid_daily(costs: DataFrame) -> DataFrame:
    """Spend, impressions and clicks by date."""
    return (
        drop_null_dims(costs, ["date_dt"])
        .groupBy("date_dt")
        .agg(
            money_sum(F.col("ad_cost")).alias("b2b_spend"),
            sum_or_zero(F.col("impressions")).alias("b2b_paid_impr"),
            sum_or_zero(F.col("clicks")).alias("b2b_paid_clicks"),
        )
    )


def pageviews_by_origin(pages: DataFrame) -> DataFrame:
    """Page views by date and web origin type."""
    return sum_by(pages, ["date_dt", "web_origin_type"], {"screenPageViews": "ga4_pageviews"})


def unique_by(df: DataFrame, dims: list[str], metrics: list[str]) -> DataFrame:
    """Exact distinct count of every metric per dim tuple, as ``unique_<metric>s``.

    An ``_id`` ending is dropped from the metric's name. Spark shuffles a distinct count on dims
    and value together, so one large dim tuple is spread over many tasks.
    """
    return (
        drop_null_dims(df, dims)
        .groupBy(*dims)
        .agg(*[F.count_distinct(m).alias(f"unique_{m.removesuffix('_id')}s") for m in metrics])
    )


def group_count(df: DataFrame, dims: list[str]) -> DataFrame:
    """Number of distinct dim tuples without nulls, as one row."""
    return drop_null_dims(df.select(*dims), dims).distinct().agg(F.count("*").alias("groups"))


def grand_total(df: DataFrame, col: str, name: str = "total") -> DataFrame:
    """Exact money total as one row."""
    return df.agg(money_sum(F.col(col)).alias(name))


def dedup_group(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key tuple."""
    return df.select(*keys).distinct()


def latest_values(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the greatest ``order`` per key, other columns unchanged. Order keys are reduced, rows are joined back."""
    return latest_rows(df, keys, order)
