"""Survey scores, routing, merged submissions and user attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rating_event, rating_of, trim_len_ok, trimmed
from ..operators.ordering import latest_rows, winning_rows


def nps_bucket(score: Column) -> Column:
    """Follow-up path of a score: 9 and up high, 7 and 8 middle, the rest low."""
    return F.when(score >= 9, F.lit("high")).when(score.isin(7, 8), F.lit("middle")).otherwise(F.lit("low"))


def nps_daily(submissions: DataFrame, by: list[str]) -> DataFrame:
    """Answers per day and dimension by path, with the share of high minus low in percent."""
    bucket = nps_bucket(F.col("score"))
    counts = submissions.where(F.col("score").isNotNull()).groupBy(*by).agg(
        F.count("*").alias("answers"),
        *[F.count_if(bucket == name).alias(name) for name in ("high", "middle", "low")],
    )
    return counts.withColumn(
        "net_score", F.try_divide((F.col("high") - F.col("low")).cast("double") * 100, F.col("answers").cast("double"))
    )


def survey_route(responses: DataFrame) -> DataFrame:
    """Where each rating leads: ratings 1 and 2 are asked for feedback of at most 255 characters.

    ``route`` is ``rating_only``, ``rating_with_feedback``, or ``ask_feedback`` while no valid
    feedback has come in. Feedback is kept, trimmed, only on the middle one.
    """
    asks = F.col("rating").cast("string").isin("1", "2")
    route = (
        F.when(~asks, F.lit("rating_only"))
        .when(trim_len_ok(F.col("feedback")), F.lit("rating_with_feedback"))
        .otherwise(F.lit("ask_feedback"))
    )
    return responses.withColumn("route", route).withColumn(
        "feedback", F.when(F.col("route") == "rating_with_feedback", trimmed(F.col("feedback")))
    )


def merge_submissions(parts: DataFrame, keys: tuple[str, ...] = ("uuid", "timestamp")) -> DataFrame:
    """One row per submission from its score, reason and feedback parts."""
    fields = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in fields])


WRITE = ["user_id", "ts", "seq", "attribute", "value"]


def last_writes(attributes: DataFrame) -> DataFrame:
    """Last value of every user and attribute, in the same long form as the input."""
    return latest_rows(attributes.select(*WRITE), ["user_id", "attribute"], ["ts", "seq"])


def latest_attributes(attributes: DataFrame, names: list[str]) -> DataFrame:
    """Last value of the named attributes per user, as columns.

    The last writes are found by their order alone; a user's values, one per name, then make a map.
    """
    wanted = attributes.where(F.col("attribute").isin(names)).select(*WRITE)
    last = winning_rows(wanted, ["user_id", "attribute"], ["ts", "seq"])
    known = F.map_from_entries(F.collect_set(F.struct("attribute", "value")))  # a set: writes may be repeated
    users = last.groupBy("user_id").agg(known.alias("_known"))
    return users.select("user_id", *[F.element_at("_known", F.lit(n)).alias(n) for n in names])


def rating_counts(events: DataFrame, rating: str = "rating") -> DataFrame:
    """App rating events by name, with the rating read back from the name."""
    named = events.select(rating_event(F.col(rating)).alias("event_name"))
    return (
        named.where(F.col("event_name").isNotNull())
        .groupBy("event_name")
        .agg(F.count("*").alias("events"))
        .withColumn("rating", rating_of(F.col("event_name")))
    )
