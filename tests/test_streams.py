"""Streams give the batch result whatever the order of arrival, and survive a restart."""

import datetime

import pytest

from campaign_analytics.plans.attribution import first_touch, page_event
from campaign_analytics.plans.surveys import latest_attributes
from campaign_analytics.sources.jobs import read_job_events
from campaign_analytics.streaming import jobs, store

TOUCH = "event_id long, user_id string, ts timestamp_ntz, url string, referrer string"
START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


# The second file holds touches that are earlier than those of the first one.
FIRST = [
    (5, "a", at(50), "https://e.com/", "https://www.bing.com/"),
    (6, "b", at(60), "https://e.com/?first_ref=partner", None),
    (7, "c", at(70), "https://e.com/", None),
]
LATE = [
    (1, "a", at(10), "https://e.com/?gclid=1", "https://www.google.com/"),
    (2, "b", at(90), "https://e.com/", "https://www.google.com/"),
    (3, "c", at(5), "https://e.com/", "localhost"),
]


def add_file(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def touch_stream(spark, path):
    return spark.readStream.schema(TOUCH).parquet(path)


def test_first_touch_out_of_order_and_restarted(spark, tmp_path):
    src, check, out = (str(tmp_path / n) for n in ("src", "check", "out"))
    add_file(spark, FIRST, TOUCH, src)
    jobs.stream_first_touch(touch_stream(spark, src), check, out, once=True).awaitTermination()
    early = {r.user_id: r.first_referrer for r in jobs.read_first_touch(spark, out).collect()}
    assert early == {"a": "bing", "b": "partner", "c": None}
    jobs.compact_first_touch(spark, out)
    add_file(spark, LATE, TOUCH, src)
    for _ in range(2):
        jobs.stream_first_touch(touch_stream(spark, src), check, out, once=True).awaitTermination()
    got = {r.user_id: r.first_referrer for r in jobs.read_first_touch(spark, out).collect()}
    want = {r.user_id: r.first_referrer for r in first_touch(spark.read.parquet(src)).collect()}
    assert got == want == {"a": "google", "b": "partner", "c": None}


def first_touches(df):
    return {r.user_id: r.first_referrer for r in df.collect()}


def test_compaction_while_the_query_runs(spark, tmp_path):
    """A batch that arrives during the compaction is neither lost nor doubled, nor are batches of a restart."""
    src, check, out = (str(tmp_path / n) for n in ("src", "check", "out"))
    add_file(spark, FIRST, TOUCH, src)

    def run():
        jobs.stream_first_touch(touch_stream(spark, src), check, out, once=True).awaitTermination()

    run()
    before = jobs.read_first_touch(spark, out)

    def merge_while_more_arrives(batches):
        add_file(spark, LATE, TOUCH, src)
        run()
        return jobs._latest_result(batches)

    assert store.compact(spark, out, merge_while_more_arrives) == 0
    want = first_touches(first_touch(spark.read.parquet(src)))
    assert first_touches(jobs.read_first_touch(spark, out)) == want
    assert first_touches(before) == {"a": "bing", "b": "partner", "c": None}  # a reader from before goes on
    assert jobs.compact_first_touch(spark, out) == 1
    assert store.vacuum(spark, out) == 3  # two batches and the first snapshot
    assert first_touches(jobs.read_first_touch(spark, out)) == want
    add_file(spark, [(9, "d", at(1), "https://e.com/", "https://www.bing.com/")], TOUCH, src)
    run()
    assert first_touches(jobs.read_first_touch(spark, out)) == {**want, "d": "bing"}


def test_batches_count_once_and_only_when_complete(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = spark.createDataFrame([(1,), (2,)], "v int")
    with pytest.raises(ValueError, match="no batch"):
        store.read_batches(spark, out)
    store.write_batch(frame, 0, out)
    store.write_batch(frame, 1, out)
    store.write_batch(frame.where("v = 1"), 1, out)  # the same batch again, after a restart
    frame.write.parquet(out + "/data/batch-2-left-behind")  # died before its log entry
    rows = lambda: sorted((r.batch_id, r.v) for r in store.read_batches(spark, out).collect())
    assert rows() == [(0, 1), (0, 2), (1, 1)]
    assert store.vacuum(spark, out) == 0
    store.compact(spark, out, lambda df: df.select("v").distinct())
    assert rows() == [(1, 1), (1, 2)]
    store.write_batch(frame, 1, out)  # repeated after the compaction that holds it
    assert rows() == [(1, 1), (1, 2)]
    store.write_batch(frame.where("v = 2"), 2, out)
    assert rows() == [(1, 1), (1, 2), (2, 2)]


def test_the_slower_of_two_compactions_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    store.write_batch(spark.range(5), 0, out)

    def merge_and_be_overtaken(df):
        store.compact(spark, out, lambda same: same.select("id"))
        return df.limit(0).select("id")

    with pytest.raises(Exception, match="exist"):
        store.compact(spark, out, merge_and_be_overtaken)
    assert store.read_batches(spark, out).count() == 5


def test_sessions_are_written_once_they_are_over(spark, tmp_path):
    src, check, out = (str(tmp_path / n) for n in ("src", "check", "out"))

    def run(*visits):
        add_file(spark, [(i, u, t if t is None else at(t), "https://e.com/", ref) for i, u, t, ref in visits], TOUCH, src)
        stream = touch_stream(spark, src)
        jobs.stream_sessions(stream, check, out, gap="30 minutes", late_by="10 minutes", once=True).awaitTermination()
        rows = spark.read.parquet(out).collect()
        start = lambda r: int((r.session_start.replace(tzinfo=None) - START).total_seconds() // 60)
        return sorted((r.user_id, start(r), r.touches, r.first_referrer) for r in rows)

    bing, google = "https://www.bing.com/", "https://www.google.com/"
    assert run((1, "a", 0, None), (2, "a", 5, google), (3, "a", 35, bing), (4, "z", 60, None), (5, "n", None, None)) == []
    # Minute 100: the watermark is at 90, past the end of a's first session at 65, and at the end of z's.
    first = run((6, "a", 100, bing))
    assert first == [("a", 0, 3, "google"), ("z", 60, 1, None)]
    # A touch of minute 30 is behind the watermark with its whole session; one of minute 75 still counts.
    later = run((7, "a", 30, google), (8, "b", 75, google), (9, "a", 500, None))
    assert later == [*first[:1], ("a", 100, 1, "bing"), ("b", 75, 1, "google"), *first[1:]]


def test_touches_row_by_row(spark, tmp_path):
    src, check, out = (str(tmp_path / n) for n in ("src", "check", "out"))
    for rows in (FIRST, LATE):
        add_file(spark, rows, TOUCH, src)
        jobs.stream_touches(touch_stream(spark, src), check, out, once=True).awaitTermination()
    got = sorted(map(repr, spark.read.parquet(out).collect()))
    assert got == sorted(map(repr, page_event(spark.read.parquet(src)).collect()))


def test_profile_upserts(spark, tmp_path):
    src, check, out = (str(tmp_path / n) for n in ("src", "check", "out"))
    schema = "user_id string, ts timestamp_ntz, seq long, attribute string, value string"
    for rows in (
        [("a", at(9), 1, "nps", "9"), ("a", at(9), 2, "nps", "8"), ("b", at(1), 3, "type", "S")],
        [("a", at(2), 4, "nps", "1"), ("b", at(5), 5, "type", "J"), ("b", at(5), 6, "nps", None)],
    ):
        add_file(spark, rows, schema, src)
        stream = spark.readStream.schema(schema).parquet(src)
        jobs.stream_profile(stream, check, out, once=True).awaitTermination()
        jobs.compact_profile(spark, out)
    names = ["nps", "type"]
    got = sorted(map(repr, jobs.read_profile(spark, out, names).collect()))
    assert got == sorted(map(repr, latest_attributes(spark.read.parquet(src), names).collect()))
    assert "nps='8'" in got[0]


def test_intake(spark, tmp_path):
    src, check, out = (str(tmp_path / n) for n in ("src", "check", "out"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.json").write_text('{"referenceNumber": "R1", "jobTitle": "Bar", "extra": 1}\n')
    jobs.stream_intake(read_job_events(spark, src, stream=True), check, out, once=True).awaitTermination()
    row = spark.read.parquet(out).collect()[0]
    assert (row.status, row.referencenumber, row.title, row.city) == ("DRAFT", "R1", "Bar", None)
