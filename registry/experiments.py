"""A/B tests and surveys, over results derived from events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_analytics.plans import experiments as plan
from campaign_analytics.plans import surveys

from .tables import by_index, day_text, key_count, read, sql_index, ts_text, with_tables

ARMS = ["control", "A", "B"]
ATTRIBUTES = ["view", "click", "purchase", "never"]
SEED = "autumn"

SQL = {
    "ab_results": f"""
    SELECT 't' || (user_id % 20) AS test_id, {sql_index(ARMS, "event_id % 3")} AS arm, count(*) AS users,
           count(*) FILTER (WHERE value > 40) AS conversions
    FROM events GROUP BY ALL""",
    "slots": f"""
    SELECT c_custkey, CAST('0x' || substr(sha256(c_custkey || '{SEED}'), 1, 8) AS BIGINT) AS h FROM customer""",
    "scored": """
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS score FROM events""",
}


def ab_results(spark, d):
    return (
        read(spark, d, "events")
        .select(
            F.concat(F.lit("t"), (F.col("user_id") % 20).cast("string")).alias("test_id"),
            by_index(ARMS, "event_id % 3").alias("group_name"),
            "value",
        )
        .groupBy("test_id", "group_name")
        .agg(F.count("*").alias("users"), F.count_if(F.col("value") > 40).alias("conversions"))
        .withColumn("is_control", F.col("group_name") == "control")
    )


def ab_significance(spark, d):
    return plan.ab_significance(ab_results(spark, d))


def group_size_check(spark, d):
    groups = ab_results(spark, d).withColumn(
        "percent",
        F.when(F.col("is_control"), 20).when(F.col("test_id").isin("t1", "t2", "t3"), 30).otherwise(40),
    )
    return plan.group_size_check(groups)


def assign_groups(spark, d):
    users = read(spark, d, "customer").select("c_custkey")
    return plan.assign_groups(users, "c_custkey", {"control": 20, "A": 50, "B": 30}, SEED)


def split_in_half(spark, d):
    return plan.split_in_half(read(spark, d, "customer").select("c_custkey"), "c_custkey", SEED)


def _scored(spark, d):
    return read(spark, d, "events").withColumn("score", key_count() % 10 + 1)


def nps_daily(spark, d):
    return surveys.nps_daily(
        _scored(spark, d).select(day_text("ts").alias("day"), F.col("event_type").alias("device"), "score"), ["day", "device"]
    )


def survey_route(spark, d):
    responses = read(spark, d, "conversations").select(
        "conv_id", "turn", ((F.col("conv_id") + F.col("turn")) % 5 + 1).alias("rating"), F.col("text").alias("feedback")
    )
    return surveys.survey_route(responses)


def merge_submissions(spark, d):
    """Three sparse rows per event put together again."""
    rows = _scored(spark, d).select(F.col("user_id").alias("uuid"), F.col("ts").alias("timestamp"), "score", "event_type", "props")
    empty = F.lit(None)
    parts = F.array(
        F.struct(F.col("score").alias("score"), empty.cast("string").alias("reason"), empty.cast("string").alias("feedback")),
        F.struct(empty.cast("bigint").alias("score"), F.col("event_type").alias("reason"), empty.cast("string").alias("feedback")),
        F.struct(empty.cast("bigint").alias("score"), empty.cast("string").alias("reason"), F.col("props").alias("feedback")),
    )
    sparse = rows.select("uuid", "timestamp", F.explode(parts).alias("part")).select("uuid", "timestamp", "part.*")
    return surveys.merge_submissions(sparse).withColumn("timestamp", ts_text("timestamp"))


def attributes_from(events):
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("attribute"),
        key_count().cast("string").alias("value"),
    )


def latest_attributes(spark, d):
    return surveys.latest_attributes(attributes_from(read(spark, d, "events")), ATTRIBUTES)


def rating_counts(spark, d):
    return surveys.rating_counts(read(spark, d, "events").select((key_count() % 6).alias("rating")))


QUERIES = {
    "ab_significance": ab_significance,
    "group_size_check": group_size_check,
    "assign_groups": assign_groups,
    "split_in_half": split_in_half,
    "nps_daily": nps_daily,
    "survey_route": survey_route,
    "merge_submissions": merge_submissions,
    "latest_attributes": latest_attributes,
    "rating_counts": rating_counts,
}

_TRIM = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_LAST = ", ".join(
    f"arg_max(json_extract_string(props, '$.k'), (ts, event_id)) FILTER (WHERE event_type = '{name}') AS {name}"
    for name in ATTRIBUTES
)
LATEST_SQL = f"""SELECT 'u' || user_id AS user_id, {_LAST} FROM events
    WHERE event_type IN ('view', 'click', 'purchase', 'never') GROUP BY user_id"""

ORACLE = {
    "ab_significance": with_tables(
        """
    SELECT test_id, group_name, control_rate, test_rate,
           CAST(CAST(control_rate * 100 AS DECIMAL(20,2)) AS VARCHAR) || '%' AS control_rate_text,
           CAST(CAST(test_rate * 100 AS DECIMAL(20,2)) AS VARCHAR) || '%' AS test_rate_text, z,
           CASE WHEN abs(z) > 1.96 THEN 'Significant' ELSE 'Not significant' END AS result
    FROM (SELECT test_id, group_name, p0 AS control_rate, p1 AS test_rate,
                 (p1 - p0) / nullif(sqrt(p * (1 - p) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n0)), 0) AS z
          FROM (SELECT t.test_id, t.arm AS group_name, CAST(t.users AS DOUBLE) AS n1, CAST(c.users AS DOUBLE) AS n0,
                       CAST(t.conversions AS DOUBLE) / t.users AS p1, CAST(c.conversions AS DOUBLE) / c.users AS p0,
                       CAST(t.conversions + c.conversions AS DOUBLE) / (t.users + c.users) AS p
                FROM ab_results t JOIN ab_results c ON c.test_id = t.test_id AND c.arm = 'control'
                WHERE t.arm <> 'control'))""",
        SQL,
    ),
    "group_size_check": with_tables(
        """
    SELECT test_id, CAST(sum(p) AS BIGINT) AS total_percent,
           CASE WHEN sum(p) = 100 THEN 'ok' ELSE 'Group percentages must add up to 100' END AS message
    FROM (SELECT test_id, CASE WHEN arm = 'control' THEN 20 WHEN test_id IN ('t1', 't2', 't3') THEN 30 ELSE 40 END AS p
          FROM ab_results) GROUP BY test_id""",
        SQL,
    ),
    "assign_groups": with_tables(
        """SELECT c_custkey, CASE WHEN h % 10000 < 2000 THEN 'control' WHEN h % 10000 < 7000 THEN 'A' ELSE 'B' END
        AS group_name FROM slots""",
        SQL,
    ),
    "split_in_half": with_tables(
        """SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY h % 65536, c_custkey) <= count(*) OVER () // 2
        THEN 'A' ELSE 'B' END AS team FROM slots""",
        SQL,
    ),
    "nps_daily": with_tables(
        """
    SELECT *, CAST(high - low AS DOUBLE) * 100 / answers AS net_score
    FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS device, count(*) AS answers,
                 count(*) FILTER (WHERE score IN (9, 10)) AS high, count(*) FILTER (WHERE score BETWEEN 7 AND 8) AS middle,
                 count(*) FILTER (WHERE score <= 6) AS low
          FROM scored GROUP BY ALL)""",
        SQL,
    ),
    "survey_route": f"""
    SELECT conv_id, turn, rating, CASE WHEN rating > 2 THEN 'rating_only' WHEN ok THEN 'rating_with_feedback'
           ELSE 'ask_feedback' END AS route, CASE WHEN rating <= 2 AND ok THEN body END AS feedback
    FROM (SELECT conv_id, turn, (conv_id + turn) % 5 + 1 AS rating, {_TRIM} AS body,
                 length({_TRIM}) BETWEEN 1 AND 255 AS ok FROM conversations)""",
    "merge_submissions": with_tables(
        """SELECT user_id AS uuid, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", max(score) AS score,
        max(event_type) AS reason, max(props) AS feedback FROM scored GROUP BY user_id, ts""",
        SQL,
    ),
    "latest_attributes": LATEST_SQL,
    "rating_counts": """SELECT 'UserRatedApp' || r AS event_name, count(*) AS events, CAST(r AS INTEGER) AS rating
    FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 6 AS r FROM events) WHERE r > 0 GROUP BY r""",
}
