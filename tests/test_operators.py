"""Building blocks: batches, numbering, unions, lookups, privacy, feeds."""

import json
from collections import Counter
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from campaign_analytics.functions.identity import pseudonym
from campaign_analytics.operators import aggregates, filters, joins, numbering, payloads, sets, windows
from campaign_analytics.plans import experiments, feeds, privacy, reviews, surveys
from campaign_analytics.sources import jobs, reports, sinks


@pytest.mark.parametrize(("n", "shards"), [(0, 4), (1, 4), (137, 4), (50, None), (137, None), (500, None)])
def test_batches_hold_every_record_once(spark, n, shards):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"))
    out = payloads.batch_payloads(df, "id", F.struct("id"), "users", size=50, shards=shards).collect()
    bodies = [json.loads(r.payload)["users"] for r in out]
    assert [len(b) for b in bodies] == [r.records for r in out] and all(1 <= len(b) <= 50 for b in bodies)
    assert sorted(int(u["id"]) for b in bodies for u in b) == list(range(n))
    if shards is None:
        assert len(bodies) == -(-n // 50)


def test_global_numbers_are_dense_and_ignore_row_order(spark):
    df = spark.range(1000).withColumn("id", F.col("id").cast("string"))
    first = {r.id: (r.n, r.total) for r in numbering.global_row_number(df, "id", out="n", total="total").collect()}
    again = numbering.global_row_number(df.orderBy(F.rand(3)), "id", out="n", total="total").collect()
    assert {r.id: (r.n, r.total) for r in again} == first
    assert sorted(n for n, _ in first.values()) == list(range(1000))
    assert {t for _, t in first.values()} == {1000}


@pytest.mark.parametrize("n", [0, 1, 2, 101])
def test_halves(spark, n):
    df = spark.range(n)
    teams = Counter(r.team for r in experiments.split_in_half(df, "id").collect())
    assert (teams["A"], teams["B"]) == (n // 2, n - n // 2)


def test_assignment_is_stable_and_near_its_shares(spark):
    df = spark.range(20_000)
    groups = {r.id: r.group_name for r in experiments.assign_groups(df, "id").collect()}
    shuffled = experiments.assign_groups(df.repartition(7), "id").collect()
    assert {r.id: r.group_name for r in shuffled} == groups
    assert abs(Counter(groups.values())["control"] / 20_000 - 0.2) < 0.02
    other = {r.id: r.group_name for r in experiments.assign_groups(df, "id", seed="x").collect()}
    assert other != groups
    with pytest.raises(ValueError, match="100"):
        experiments.assign_groups(df, "id", {"a": 50})


def test_stack_keeps_rows_and_leaves_gaps_null(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 0.5)], "k int, b double")
    assert sorted(tuple(r) for r in sets.stack([a, b]).collect()) == [(1, "x", None), (2, None, 0.5)]


def test_null_dims_form_no_group_and_nulls_are_not_counted(spark):
    rows = [("a", "x", 1, 1), ("a", "x", 1, 2), ("a", "x", None, 3), (None, "x", 9, 9), ("a", None, 9, 9)]
    df = spark.createDataFrame(rows, "p string, q string, order_id int, shift_id int")
    out = aggregates.unique_by(df, ["p", "q"], ["order_id", "shift_id"]).collect()
    assert [r.asDict() for r in out] == [{"p": "a", "q": "x", "unique_orders": 1, "unique_shifts": 3}]
    assert aggregates.group_count(df, ["p", "q"]).collect()[0].groups == 1
    sums = aggregates.sum_by(df, ["p"], {"order_id": "total"}).collect()
    assert [tuple(r) for r in sums] == [("a", 11)]
    empty = spark.createDataFrame([("a", None)], "p string, v double")
    assert aggregates.sum_by(empty, ["p"], {"v": "v"}).collect()[0].v == 0


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, cpc int")
    assert filters.drop_cols(df, ["cpc", "none"]).columns == ["a", "b"]
    assert filters.dims_first(df, ["b"]).columns == ["b", "a", "cpc"]
    assert filters.rename_with(df, {"a": "x"}).columns == ["x", "b", "cpc"]
    assert filters.rename_with(df, lambda c: f"p_{c}").columns == ["p_a", "p_b", "p_cpc"]
    assert filters.distinct_rows(df.union(df), ["a"]).count() == 1
    assert aggregates.dedup_group(df.union(df), ["a", "b"]).count() == 1


def test_last_duplicate_wins_in_lookups(spark):
    trackers = spark.createDataFrame(
        [("P - C", "a1", "i1", 1), ("P - C", "a2", "i2", 2)], "platform_channel string, android string, ios string, seq int"
    )
    requests = spark.createDataFrame([("P", "C"), ("P", "X"), (None, "C")], "platform string, channel string")
    got = {(r.platform, r.channel): r.android_id for r in joins.tracker_lookup(requests, trackers, order="seq").collect()}
    assert got == {("P", "C"): "a2", ("P", "X"): None, (None, "C"): None}
    feed = spark.createDataFrame([("a", 1, "old"), ("a", 5, "new"), ("b", 2, None)], "rid string, row_no int, v string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "want string")
    out = {r.want: (r.v, r.found) for r in joins.row_by_id(feed, asked, "rid", "want").collect()}
    assert out == {"a": ("new", True), "b": (None, True), "c": (None, False), None: (None, False)}


def test_repeated_names_need_an_order(spark):
    table = spark.createDataFrame(
        [("P - C", "z", "a", "c", 1), ("P - C", "b", "a", "c", 2), ("P - D", "d", "d", "d", 1), ("P - D", "d", "d", "d", 1), (None, "n", "n", "n", 1),
         (None, "m", "n", "n", 2)],
        "platform_channel string, campaign string, adgroup string, creative string, seq int",
    )
    asked = spark.createDataFrame([("P", "C", None, None, None), ("P", "D", "own", None, None)],
                                  "platform string, channel string, campaign string, adgroup string, creative string")
    last = {r.channel: (r.campaign, r.adgroup) for r in joins.default_campaign(asked, table, order="seq").collect()}
    assert last == {"C": ("b", "a"), "D": ("own", "d")}
    unordered = joins.default_campaign(asked, table)
    with pytest.raises(Exception, match="different rows for platform_channel = P - C"):
        unordered.collect()
    once = joins.default_campaign(asked, table.where("campaign <> 'z'")).collect()
    assert {r.channel: r.campaign for r in once} == {"C": "b", "D": "own"} and len(once) == 2
    words = spark.createDataFrame([("a", "first", 1), ("a", "last", 2), ("b", "", 1)], "k string, v string, seq int")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    got = joins.map_lookup(keys, "k", words, "k", "v", "out", F.lit("none"), order="seq").collect()
    assert {r.k: r.out for r in got} == {"a": "last", "b": "none", "c": "none", None: "none"} and len(got) == 4


def test_top1_and_first_over_and_pages(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("a", 2, "y"), ("b", 5, None), (None, 1, "n")], "k string, v int, s string"
    )
    assert sorted((r.k or "", r.v) for r in windows.top1_ties(df, ["k"], "v").collect()) == [("", 1), ("a", 2), ("a", 2), ("b", 5)]
    first = {r.k: r.s for r in windows.first_over(df, ["k"], "s", ["v", "s"]).collect()}
    assert first == {"a": "x", "b": None, None: "n"}
    links = spark.range(25).withColumnRenamed("id", "seq")
    page = sets.page_of(links, "seq", 3).collect()
    assert [r.seq for r in page] == [4, 3, 2, 1, 0]
    assert {(r.length, r.total_pages, r.page) for r in page} == {(25, 3, 3)}
    assert sets.page_of(links, "seq", 4).collect() == []


def test_anonymized_users_keep_nothing(spark):
    rows = [(f"u{i}", f"m{i}@e.com", f"0{i}", f"F{i}", f"L{i}", "1990-01-01") for i in range(120)]
    users = spark.createDataFrame(
        rows, "external_id string, email string, phone string, first_name string, last_name string, dob string"
    )
    ids = spark.createDataFrame([(f"u{i}",) for i in range(0, 120, 2)] + [("u0",), ("gone",)], "id string")
    out = privacy.anonymize_users(users, ids, "s", shards=2)
    after = out.users.collect()
    assert len(after) == 120
    text = json.dumps([r.asDict() for r in after])
    for i, row in enumerate(rows):
        assert (f'"{row[0]}"' in text) == bool(i % 2) and (row[1] in text) == bool(i % 2)
    renamed = {r.current_external_id: r.new_external_id for r in out.rename_map.collect()}
    assert len(renamed) == 61 and len(set(renamed.values())) == 61
    want = {u: v for (u, v) in ids.distinct().select("id", pseudonym(F.col("id"), "s")).collect()}
    assert renamed == want
    sent = [r for p in out.rename_payloads.collect() for r in json.loads(p.payload)["external_id_renames"]]
    assert {r["current_external_id"]: r["new_external_id"] for r in sent} == renamed
    assert joins.suppress(users, ids, "external_id").count() == 60


def test_reports_from_responses(spark):
    df = spark.createDataFrame([("s1", '{"2024-01-01": {"visits": 3, "rate": "4%"}, "2024-01-02": {}}')], "site string, body string")
    flat = reports.flatten_metrics_by_date(df, "body", ["visits", "rate", "none"]).orderBy("date").collect()
    assert [tuple(r) for r in flat] == [("s1", "2024-01-01", 3.0, None, None), ("s1", "2024-01-02", None, None, None)]
    schema = (
        "dimension_headers array<struct<name:string>>, metric_headers array<struct<name:string>>, "
        "rows array<struct<dimension_values:array<struct<value:string>>,metric_values:array<struct<value:string>>>>"
    )
    response = spark.createDataFrame(
        [([("date",), ("page",)], [("users",)], [([("20240105",), ("/x",)], [("7",)]), ([("bad",), ("/y",)], [("8.5",)])])], schema
    )
    rows = reports.typed_report(reports.flatten_report(response, ["page", "date", "absent"], ["users"]), ["users"])
    assert [(r.page, str(r.date), r.absent, r.users) for r in rows.collect()] == [
        ("/x", "2024-01-05", None, 7.0), ("/y", "None", None, 8.5),
    ]


def test_date_batches_cover_every_day_once(spark):
    bounds = spark.sql("SELECT date'2024-01-01' AS start_date, date'2024-02-15' AS end_date")
    got = [(str(r.first_day), str(r.last_day)) for r in reports.date_batches(bounds, 20).orderBy("batch").collect()]
    assert got == [("2024-01-01", "2024-01-20"), ("2024-01-21", "2024-02-09"), ("2024-02-10", "2024-02-15")]


def test_merged_submissions_and_latest_values(spark):
    parts = spark.createDataFrame(
        [("u", "t1", 9, None), ("u", "t1", None, "fast"), ("u", "t2", 3, None)], "uuid string, timestamp string, score int, reason string"
    )
    assert sorted(tuple(r) for r in surveys.merge_submissions(parts).collect()) == [("u", "t1", 9, "fast"), ("u", "t2", 3, None)]
    writes = spark.createDataFrame(
        [("u", 1, 1, "nps", "3"), ("u", 1, 2, "nps", "7"), ("u", 0, 9, "type", "S"), ("v", 5, 1, "other", "x")],
        "user_id string, ts int, seq int, attribute string, value string",
    )
    out = surveys.latest_attributes(writes, ["nps", "type"]).collect()
    assert [r.asDict() for r in out] == [{"user_id": "u", "nps": "7", "type": "S"}]


def test_job_views(spark):
    feed = feeds_rows(spark)
    requests = spark.createDataFrame(
        [(1, None, "3"), (2, "A", None), (3, "A", "1"), (4, "B", "x"), (5, "Z", None), (6, "A", "99"), (7, "", None)],
        "request_id int, job_id string, dav string",
    )
    got = {r.request_id: (r.result, r.title, r.description) for r in feeds.job_view(feed, requests).collect()}
    assert {k: v[:2] for k, v in got.items()} == {
        1: ("generic", None), 2: ("ok", "a2"), 3: ("jobInactive", None), 4: ("ok", "b"), 5: ("jobNotFound", None),
        6: ("jobNotFound", None), 7: ("generic", None),
    }
    assert feeds.NOTE_EN in got[2][2] and feeds.NOTE_DE in got[4][2]


def feeds_rows(spark):
    rows = [
        ("DRAFT", "A", "a1", "d", "de", 1), ("LIVE", "A", "a2", "d", "en", 2), ("LIVE", "B", "b", None, None, 3),
    ]
    df = spark.createDataFrame(rows, "status string, referencenumber string, title string, description string, language string, row_no int")
    return df.withColumns({c: F.lit("x") for c in ("date", "city", "salary", "url", "jobtype", "category", "endDate")})


def test_feed_round_trip_through_xml(spark, tmp_path):
    feed = feeds.job_feed(feeds_rows(spark), "A & B", "C <D>")
    sinks.write_job_xml(feed, str(tmp_path / "feed"), 'A "&" B', "https://e.com/?a=1&b=2", "2024-01-01T00:00:00.000Z")
    back = sinks.read_published_xml(spark, str(tmp_path / "feed"), feed.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, feed.collect()))
    head = sinks.read_published_xml(spark, str(tmp_path / "feed"), feed.columns, header=True).select(*sinks.HEADER).distinct()
    assert [tuple(r) for r in head.collect()] == [('A "&" B', "https://e.com/?a=1&b=2", "2024-01-01T00:00:00.000Z")]


@pytest.mark.parametrize(("n", "per_document"), [(0, 5), (7, 50), (57, 10)])
def test_every_feed_document_is_complete(spark, tmp_path, n, per_document):
    feed = spark.range(n).select(F.col("id").cast("string").alias("title"), (F.col("id") % 3).alias("rank"), F.lit("<&>").alias("text"))
    path = tmp_path / "feed"
    sinks.write_job_xml(feed, str(path), "P", "U", "T", order=["rank", "title"], jobs_per_document=per_document)
    titles = []
    files = [f for f in path.glob("*.txt") if f.stat().st_size]
    assert len(files) <= max(1, -(-n // per_document)) and (len(files) == 1 or n > per_document)
    for file in files:
        root = ElementTree.fromstring(file.read_text())
        assert root.tag == "source" and [root.find(h).text for h in sinks.HEADER] == ["P", "U", "T"]
        assert [c.tag for c in root] == [*sinks.HEADER, *["job"] * (len(root) - 3)]
        jobs_here = [(int(j.find("rank").text), j.find("title").text) for j in root.iter("job")]
        assert jobs_here == sorted(jobs_here)
        titles += [t for _, t in jobs_here]
    assert sorted(titles) == sorted(str(i) for i in range(n))


def test_named_tables_are_replaced_in_one_step(spark):
    sinks.replace_table(spark.range(3), "replaced_report")
    reader = spark.table("replaced_report")
    plan = reader.groupBy().sum("id")
    failing = spark.range(5).select(F.expr("IF(id = 4, raise_error('lost'), id)").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(failing, "replaced_report")
    assert spark.table("replaced_report").count() == 3
    sinks.replace_table(spark.range(10).select("id", F.lit("x").alias("more")), "replaced_report")
    assert spark.table("replaced_report").columns == ["id", "more"] and spark.table("replaced_report").count() == 10
    assert plan.first()[0] == 3  # who began before reads the old version
    # A report made from its own last version.
    sinks.replace_table(spark.table("replaced_report").where("id < 4"), "replaced_report")
    assert spark.table("replaced_report").count() == 4


def test_board_listings(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        """<feed><joblisting reference_id="R1"><jobdetails><jobtitle>Bar &amp; Co</jobtitle>
        <joblocations><location><city>Köln</city></location><location><city>Bonn</city></location></joblocations>
        <introduction><![CDATA[<div>I</div>]]></introduction><offer>O</offer><tasks>T</tasks><profile>P</profile>
        <contactinfo>C</contactinfo></jobdetails></joblisting></feed>""",
        encoding="utf-8",
    )
    listing = feeds.job_description(jobs.read_job_xml(spark, str(tmp_path / "a.xml"), "stepstone"), "en").collect()
    assert [tuple(r) for r in listing] == [(
        "R1", "Bar & Co", "Köln, Bonn",
        "<div>I</div><h4>Your benefits with us</h4>O<h4>Your tasks</h4>T<h4>Your profile</h4>P"
        "<h4>What are the next steps?</h4>C",
    )]
    (tmp_path / "b.xml").write_text(
        '<x><job id="7"><name>N</name><region>Ulm</region><salary>13</salary><description>D</description></job></x>'
    )
    flat = jobs.read_job_xml(spark, str(tmp_path / "b.xml"), "jobsora").collect()
    assert [tuple(r) for r in flat] == [("7", "N", "Ulm", "13", "D")]


def test_review_decisions(spark):
    rows = [
        (1, 1, "approve", "it's", None, "ann", "2024-07-01 10:00:00"),
        (1, 2, "edit", "it's", "isn't", "bob", "2024-07-01 11:00:00"),
        (2, 1, "approve", None, None, "ann", "2024-01-01 10:00:00"),
    ]
    df = spark.createDataFrame(
        rows, "review_id int, action_id int, action string, response string, edited_response string, approver string, t string"
    ).withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    got = {r.review_id: r for r in reviews.review_decisions(df).collect()}
    assert got[1].audit_line == "Response submitted by bob on 1.7.2024, 13:00:00"
    assert (got[1].final_response, got[1].checked_response) == ("isn't", "isn''t")
    assert (got[2].audit_line, got[2].final_response) == ("Response approved by ann on 1.1.2024, 11:00:00", "No response available")
    assert {r.checked_response for r in reviews.review_decisions(df, escape=False).collect()} == {"isn't", "No response available"}


def test_link_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(2):
        sinks.append_link_log(spark.createDataFrame([(i, f"l{i}")], "seq long, link string"), path)
    assert sorted(map(tuple, sinks.read_link_log(spark, path).collect())) == [(0, "l0"), (1, "l1")]
