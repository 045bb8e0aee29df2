"""The attribution, intake and profile rules over streams.

Each job takes a streaming DataFrame, a checkpoint folder and a sink folder, and returns the started
query. With ``once=True`` it works off what is there and stops. Jobs that correct earlier results
write every micro-batch as a part of its own to a table with a log, see ``store``; the matching
``read_*`` function merges the parts. When many have gathered, ``compact_*`` brings them into one,
also while the query runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.attribution import TOUCH_ORDER, page_event, touch_referrer
from ..plans.surveys import last_writes, latest_attributes
from .store import compact, read_batches, write_batch


def _start(df: DataFrame, checkpoint: str, once: bool, mode: str = "append"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer


def _per_batch(sink: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df):
    return lambda batch, batch_id: write_batch(shape(batch), batch_id, sink)


def stream_touches(touches: DataFrame, checkpoint: str, sink: str, once: bool = False) -> StreamingQuery:
    """Page records of arriving touches. Row by row, no state."""
    return _start(page_event(touches), checkpoint, once).format("parquet").option("path", sink).start()


def stream_intake(jobs: DataFrame, checkpoint: str, sink: str, once: bool = False) -> StreamingQuery:
    """Arriving jobs as feed rows. Row by row, no state."""
    return _start(jobs, checkpoint, once).format("parquet").option("path", sink).start()


def _stored(touches: DataFrame, variant: str) -> DataFrame:
    label = touch_referrer(F.col("url"), F.col("referrer"), variant)
    return touches.select("user_id", *TOUCH_ORDER, label.alias("first_referrer"))


def _first_referrer() -> Column:
    at = F.when(F.col("first_referrer").isNotNull(), F.struct(*TOUCH_ORDER))
    return F.min_by("first_referrer", at).alias("first_referrer")


def stream_first_touch(
    touches: DataFrame, checkpoint: str, sink: str, variant: str = "signup", once: bool = False
) -> StreamingQuery:
    """First referrer of every user so far.

    State is one row per user. An earlier touch that arrives late corrects the user's result, so
    the outcome does not depend on the order of arrival.
    """
    users = _stored(touches, variant).groupBy("user_id").agg(_first_referrer())
    return _start(users, checkpoint, once, "update").foreachBatch(_per_batch(sink)).start()


def stream_sessions(
    touches: DataFrame,
    checkpoint: str,
    sink: str,
    gap: str = "30 minutes",
    late_by: str = "1 day",
    variant: str = "signup",
    once: bool = False,
) -> StreamingQuery:
    """Sessions of every user with their touches and first referrer, written once they are over.

    A session takes all touches of a user that follow one another within ``gap`` (exactly that long still counts) and
    ends that long after its last one. It is written when the watermark, the latest time seen less ``late_by``, has
    reached its end, and then leaves the state; sessions that may still grow are in no output yet. A touch that comes
    later than ``late_by`` behind the latest one is dropped if its own session, ``gap`` long, is behind the watermark.
    Touches without time belong to no session.
    """
    sessions = (
        _stored(touches, variant)
        .withColumn("at", F.col("ts").cast("timestamp"))
        .withWatermark("at", late_by)
        .groupBy("user_id", F.session_window("at", gap).alias("session"))
        .agg(F.count("*").alias("touches"), _first_referrer())
        .select(
            "user_id",
            F.col("session.start").alias("session_start"),
            F.col("session.end").alias("session_end"),
            "touches",
            "first_referrer",
        )
    )
    return _start(sessions, checkpoint, once).format("parquet").option("path", sink).start()


def read_first_touch(spark: SparkSession, sink: str) -> DataFrame:
    """Current first referrer of every user."""
    return _latest_result(read_batches(spark, sink))


def _latest_result(batches: DataFrame) -> DataFrame:
    """The result of the last batch that has the user; a batch has one row per user."""
    return (
        batches.groupBy("user_id")
        .agg(F.max(F.struct("batch_id", "first_referrer")).alias("_last"))
        .select("user_id", "_last.first_referrer")
    )


def compact_first_touch(spark: SparkSession, sink: str) -> int:
    return compact(spark, sink, _latest_result)


def stream_profile(attributes: DataFrame, checkpoint: str, sink: str, once: bool = False) -> StreamingQuery:
    """Attribute writes, reduced to the last per user and attribute within each micro-batch."""
    return _start(attributes, checkpoint, once).foreachBatch(_per_batch(sink, last_writes)).start()


def read_profile(spark: SparkSession, sink: str, names: list[str]) -> DataFrame:
    """Current attributes of every user."""
    return latest_attributes(read_batches(spark, sink).drop("batch_id"), names)


def compact_profile(spark: SparkSession, sink: str) -> int:
    return compact(spark, sink, lambda batches: last_writes(batches.drop("batch_id")))
