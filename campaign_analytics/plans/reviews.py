"""Decisions on drafted review answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import berlin_time
from ..functions.text import sql_escape
from ..operators.aggregates import latest_values


def review_decisions(actions: DataFrame, escape: bool = True) -> DataFrame:
    """Last decision on every review: final answer, audit line and outgoing text.

    An approval sends the drafted response, an edit sends the edited one. The outgoing text has
    its quotes doubled, which a development set-up can leave out.
    """
    last = latest_values(actions, ["review_id"], ["ts", "action_id"])
    edited = F.col("action") == "edit"
    verb = F.when(edited, F.lit("submitted")).otherwise(F.lit("approved"))
    final = F.when(edited, F.col("edited_response")).otherwise(F.col("response"))
    return last.select(
        "review_id",
        "action",
        F.coalesce(final, F.lit("No response available")).alias("final_response"),
        F.concat(
            F.lit("Response "), verb, F.lit(" by "), F.col("approver"), F.lit(" on "), berlin_time(F.col("ts"))
        ).alias("audit_line"),
    ).withColumn("checked_response", sql_escape(F.col("final_response")) if escape else F.col("final_response"))
