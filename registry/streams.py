"""Streaming jobs run over the event file until it is used up; the SQL is the batch result."""

from __future__ import annotations

from campaign_analytics.session import shared_dir
from campaign_analytics.sources.jobs import read_job_events
from campaign_analytics.streaming import jobs

from . import attribution, experiments, feeds
from .experiments import ATTRIBUTES, attributes_from
from .tables import SCHEMAS, touches_from, ts_text, with_tables


def _events(spark, d):
    return spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(d)


def _folders(spark, name):
    return shared_dir(spark, f"{name}-checkpoint"), shared_dir(spark, f"{name}-out")


def stream_touches(spark, d):
    checkpoint, out = _folders(spark, "touches")
    jobs.stream_touches(touches_from(_events(spark, d)), checkpoint, out, once=True).awaitTermination()
    return spark.read.parquet(out).withColumn("ts", ts_text("ts"))


def stream_first_touch(spark, d):
    checkpoint, out = _folders(spark, "first-touch")
    jobs.stream_first_touch(touches_from(_events(spark, d)), checkpoint, out, once=True).awaitTermination()
    return jobs.read_first_touch(spark, out)


def stream_sessions(spark, d):
    """Sessions that are over at the end of the file; the two days before it stay open for late touches."""
    checkpoint, out = _folders(spark, "sessions")
    stream = touches_from(_events(spark, d))
    jobs.stream_sessions(stream, checkpoint, out, gap="6 hours", late_by="2 days", once=True).awaitTermination()
    return spark.read.parquet(out).withColumns({c: ts_text(c) for c in ("session_start", "session_end")})


def stream_profile(spark, d):
    checkpoint, out = _folders(spark, "profile")
    jobs.stream_profile(attributes_from(_events(spark, d)), checkpoint, out, once=True).awaitTermination()
    return jobs.read_profile(spark, out, ATTRIBUTES)


def stream_intake(spark, d):
    posted = shared_dir(spark, "stream-posted")
    feeds.posted_jobs(spark, d).write.mode("overwrite").text(posted)
    checkpoint, out = _folders(spark, "intake")
    jobs.stream_intake(read_job_events(spark, posted, stream=True), checkpoint, out, once=True).awaitTermination()
    return spark.read.parquet(out)


QUERIES = {
    "stream_touches": stream_touches,
    "stream_first_touch": stream_first_touch,
    "stream_sessions": stream_sessions,
    "stream_profile": stream_profile,
    "stream_intake": stream_intake,
}

ORACLE = {
    "stream_touches": attribution.ORACLE["page_event"],
    "stream_first_touch": attribution.ORACLE["first_touch"],
    "stream_sessions": with_tables(
        f"""
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
           strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS touches,
           arg_min({attribution.SQL_STORED}, (ts, event_id)) FILTER (WHERE {attribution.SQL_STORED} IS NOT NULL) AS first_referrer
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS visit
          FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
                FROM touches))
    GROUP BY user_id, visit
    HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM touches) - INTERVAL 2 DAY"""
    ),
    "stream_profile": experiments.LATEST_SQL,
    "stream_intake": feeds.ORACLE["job_intake"],
}
