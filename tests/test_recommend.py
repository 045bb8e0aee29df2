"""Recommendation stages on small tables with ties, nulls, gaps and one very active talent."""

import datetime
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campaign_analytics.operators import windows
from campaign_analytics.plans import recommend as plan

AS_OF = "2024-01-31"
DAY = datetime.date(2024, 1, 31)


def stamp(rng):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=rng.randrange(30), hours=rng.randrange(3))


@pytest.fixture(scope="module", params=[1, 2])
def tables(spark, request):
    """Small value ranges make ties common; talent 0 holds a third of all activity."""
    rng = random.Random(request.param)

    def talent():
        return 0 if rng.random() < 1 / 3 else rng.randrange(12)

    rows = {
        "talent_eligibility": [
            (day, t, tag) for t in range(12) for tag in ("T0", "T1")[: 1 + t % 2] for day in (DAY, DAY - datetime.timedelta(1))
        ],
        "dim_talent": [(t, f"u{t}", f"city{t % 3}", f"region{t % 4}") for t in range(11)],
        "fact_job": [(j, f"j{j}", j % 5, f"T{j % 2}") for j in range(20)],
        "dim_job_category": [(c, f"cat{c}") for c in range(5)],
        "dim_business_region": [(f"b{b}", f"region{b % 4}") for b in range(6)],
        "fact_shift": [
            (
                talent(), rng.randrange(22), rng.randrange(5),
                None if rng.random() < 0.05 else DAY - datetime.timedelta(rng.randrange(-4, 8)), f"b{rng.randrange(7)}",
                Decimal(rng.randrange(100)), Decimal(rng.randrange(100)),
            )
            for _ in range(120)
        ],
        "job_apply_core": [(f"u{talent()}", f"j{rng.randrange(22)}", stamp(rng)) for _ in range(80)],
        "job_details_seen": [
            (f"u{talent()}", f"j{rng.randrange(22)}", stamp(rng), rng.choice([None, 1, 2, 3])) for _ in range(80)
        ],
    }
    # Talents 8 to 10 have exactly one application, or the same one twice.
    rows["job_apply_core"] = [r for r in rows["job_apply_core"] if r[0] not in ("u8", "u9")]
    rows["job_apply_core"] += [("u8", "j2", datetime.datetime(2024, 1, 5))] + [("u9", "j4", datetime.datetime(2024, 1, 6))] * 2
    schemas = {
        "talent_eligibility": "date_dt date, eligible_matched_talent long, matched_tag string",
        "dim_talent": "talent_id long, user_uuid string, employment_city string, matching_region_name string",
        "fact_job": "job_id long, job_uuid string, job_category_fk long, mandatory_include_tags string",
        "dim_job_category": "job_category_id long, job_category_name string",
        "dim_business_region": "business_region_name string, matching_region_name string",
        "fact_shift": "booked_shift_talent_id long, job_fk long, job_category_fk long, shift_dt date, "
        "business_region string, ordered_revenue_value decimal(12,2), booked_revenue_value decimal(12,2)",
        "job_apply_core": "talent_uuid string, job_uuid string, timestamp timestamp_ntz",
        "job_details_seen": "talent_uuid string, job_uuid string, last_job_details_seen timestamp_ntz, "
        "job_details_seen_count long",
    }
    frames = {name: spark.createDataFrame(rows[name], schema) for name, schema in schemas.items()}
    return rows, frames


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def talents_of(frames):
    return plan.talent_list(frames["talent_eligibility"], frames["dim_talent"], AS_OF)


def by_windows(talents, activity, jobs, categories, kind):
    """The definition itself: rank and count all rows, mark where they meet."""
    stamp, order = {
        "applied": ("timestamp", [F.col("timestamp").desc()]),
        "seen": ("last_job_details_seen", [F.col("last_job_details_seen").asc(), F.col("job_details_seen_count").desc_nulls_first()]),
    }[kind]
    extra = ("job_details_seen_count",) if kind == "seen" else ()
    rows = plan.activity_jobs(talents, activity, jobs, categories, stamp, AS_OF, extra)
    owner, job = [plan.TALENT], [plan.TALENT, "job_category_name", "matched_tag"]
    ranked = rows.select(
        plan.TALENT, "user_uuid", "job_category_name", "matched_tag",
        windows.rank_over(["talent_uuid"], order).alias("rnk"),
        windows.count_over(owner, "job_category_name").alias("cnt_shifts"),
        windows.count_over(job, "job_uuid").alias(f"{kind}_count"),
        windows.max_over(owner, stamp).alias(f"last_{kind}_job"),
    ).distinct()
    marked = ranked.withColumns({
        "ranking_by_cnt": windows.dense_rank_over(owner, [F.col(f"{kind}_count").desc()]),
        f"{kind}_preference": windows.last_rank_marker(F.col("cnt_shifts"), F.col("rnk"), F.col("job_category_name")),
        "total_selected_row": windows.single_row_flag(owner, "user_uuid"),
    })
    kept = F.col(f"{kind}_preference").isNotNull() | F.col("total_selected_row").isNotNull()
    return windows.qualify(marked, kept).drop("rnk")


KINDS = {"applied": (plan.applied_preference, "job_apply_core"), "seen": (plan.seen_preference, "job_details_seen")}


@pytest.mark.parametrize("kind", KINDS)
def test_preference_equals_its_definition(tables, kind):
    _, t = tables
    fn, table = KINDS[kind]
    args = (talents_of(t), t[table], t["fact_job"], t["dim_job_category"])
    want = rows_of(by_windows(*args, kind))
    assert rows_of(fn(*args, AS_OF)) == want
    assert rows_of(fn(args[0].withColumn("shared", F.lit(True)), *args[1:], AS_OF)) == want


@pytest.mark.parametrize("kind", KINDS)
def test_preference_when_talents_share_a_user(tables, kind):
    _, t = tables
    fn, table = KINDS[kind]
    for some in (5, 9):  # most talents share a user, or only a few do
        shared = t["dim_talent"].withColumn("user_uuid", F.concat(F.lit("u"), (F.col("talent_id") % some).cast("string")))
        args = (plan.talent_list(t["talent_eligibility"], shared, AS_OF), t[table], t["fact_job"], t["dim_job_category"])
        assert rows_of(fn(*args, AS_OF)) == rows_of(by_windows(*args, kind))


@pytest.mark.parametrize("kind", KINDS)
def test_preference_when_a_talent_has_two_users(tables, kind):
    _, t = tables
    fn, table = KINDS[kind]
    more = t["dim_talent"].where("talent_id IN (0, 3)").withColumn("user_uuid", F.expr("'u' || (talent_id + 4)"))
    talents = plan.talent_list(t["talent_eligibility"], t["dim_talent"].unionByName(more), AS_OF)
    assert "shared" not in plan.mark_shared(talents_of(t)).columns
    marked = {(r.user_uuid, r.shared) for r in plan.mark_shared(talents).collect()}
    assert {u for u, shared in marked if shared} == {"u0", "u3", "u4", "u7"}
    args = (talents, t[table], t["fact_job"], t["dim_job_category"])
    assert rows_of(fn(*args, AS_OF)) == rows_of(by_windows(*args, kind))


def activity(rows, table):
    """(talent, tag, category, order columns) of every application or view that counts."""
    users = {t: u for t, u, *_ in rows["dim_talent"]}
    jobs = {uuid: (category, tag) for _, uuid, category, tag in rows["fact_job"]}
    tags = [(t, tag) for day, t, tag in rows["talent_eligibility"] if day == DAY]
    for t, tag in tags:
        for user, job, *order in rows[table]:
            if users.get(t) == user and job in jobs and jobs[job][1] == tag:
                yield t, tag, f"cat{jobs[job][0]}", order


def test_markers_by_counting(tables):
    """The marker is the untied oldest application, and the untied latest view."""
    rows, t = tables
    for table, fn, key, oldest in [
        ("job_apply_core", plan.applied_preference, lambda o: o[0], True),
        ("job_details_seen", plan.seen_preference, lambda o: (o[0], -(o[1] if o[1] is not None else 10**9)), False),
    ]:
        owned = defaultdict(list)
        for talent, tag, category, order in activity(rows, table):
            owned[talent].append((key(order), category, tag))
        want = {}
        for talent, facts in owned.items():
            end = (min if oldest else max)(f[0] for f in facts)
            last = [f for f in facts if f[0] == end]
            if len(last) == 1:
                want[talent] = last[0][1]
            elif len(set(facts)) == 1:
                want[talent] = None
        out = fn(talents_of(t), t[table], t["fact_job"], t["dim_job_category"], AS_OF).collect()
        marker = "applied_preference" if oldest else "seen_preference"
        assert {r.eligible_matched_talent: r[marker] for r in out} == want
        assert len(out) == len(want)
        assert {r.eligible_matched_talent: r.cnt_shifts for r in out} == {k: len(owned[k]) for k in want}


def test_worked_category_by_hand(tables):
    rows, t = tables
    jobs = {j: tag for j, _, _, tag in rows["fact_job"]}
    days = defaultdict(set)
    for day, talent, tag in rows["talent_eligibility"]:
        if day == DAY:
            for owner, job, category, date, *_ in rows["fact_shift"]:
                if owner == talent and jobs.get(job) == tag:
                    days[talent, category].add((date, tag))
    want = set()
    for (talent, category), seen in days.items():
        dated = [d for d, _ in seen if d]
        every = [d for (o, _), s in days.items() if o == talent for d, _ in s if d]
        if not dated or max(dated) != max(every):
            continue
        undated = [x for x in seen if x[0] is None]
        for _, tag in undated or [x for x in seen if x[0] == max(dated)]:
            want.add((talent, f"cat{category}", tag, len(dated)))
    out = plan.worked_category(talents_of(t), t["fact_shift"], t["fact_job"], t["dim_job_category"])
    got = [(r.eligible_matched_talent, r.working_preference, r.matched_tag, r.working_count) for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_revenue_equals_the_fanned_out_sum(tables):
    rows, t = tables
    talents = talents_of(t)
    revenue = plan.unfulfilled_revenue(
        t["fact_shift"], t["fact_job"], t["dim_job_category"], t["dim_business_region"], talents, AS_OF
    )
    crowd = Counter(r.matching_region_name for r in talents.collect())
    jobs = {j: (f"cat{c}", tag) for j, _, c, tag in rows["fact_job"]}
    regions = dict(rows["dim_business_region"])
    want = defaultdict(float)
    for _, job, _, date, place, ordered, booked in rows["fact_shift"]:
        if date and DAY <= date <= DAY + datetime.timedelta(3) and crowd.get(regions.get(place, "?")):
            want[place, regions[place], *jobs.get(job, (None, None))] += float(ordered - booked) * crowd[regions[place]]
    got = {tuple(r)[:4]: r.unfulfilled_revenue for r in revenue.collect()}
    assert got == dict(want)
    best = {}
    for (_, region, category, _), value in want.items():
        if value > 0:
            best.setdefault(region, []).append((value, category))
    picks = {
        (r.eligible_matched_talent, c)
        for r in talents.collect()
        for v, c in best.get(r.matching_region_name, [])
        if v == max(best[r.matching_region_name])[0]
    }
    out = plan.eligible_preference(talents, revenue)
    assert {(r.eligible_matched_talent, r.eligible_preference) for r in out.collect()} == picks


def test_every_talent_is_listed(tables):
    _, t = tables
    fast = plan.recommend_category(t, AS_OF)
    assert {r.talent_id for r in fast.collect()} == set(range(12))
    assert fast.count() == fast.distinct().count()


def test_ranking_does_not_depend_on_the_revenue_factor(tables):
    _, t = tables
    assert rows_of(plan.recommend_category(t, AS_OF)) == rows_of(plan.recommend_category(t, AS_OF, parity=False))


def test_payload_links(spark):
    rows = [(1, "u1", "r", "c", "Bar"), (2, "u2", "r", "c", "Empty"), (3, "u3", "r", "c", None), (4, None, "r", "c", "Bar")]
    df = spark.createDataFrame(
        rows, "talent_id long, user_uuid string, matching_region_name string, employment_city string, job_category_key string"
    )
    lookup = spark.createDataFrame([("Bar", "bar"), ("Empty", "")], "job_category string, category_key string")
    bodies = plan.recommendation_payloads(df, lookup, "2024-01-31 12:00:00", base_url="app://x", shards=1)
    parsed = bodies.select(F.from_json(
        "payload", "attributes array<struct<external_id:string,rca_job_category:string,rca_deep_link:string,is_rca_date:string>>"
    ).alias("p")).select(F.inline("p.attributes")).collect()
    assert [tuple(r) for r in parsed] == [
        ("u1", "Bar", "app://x&category=bar", "2024-01-31 12:00:00"),
        ("u2", "Empty", "app://x", "2024-01-31 12:00:00"),
        ("u3", None, "app://x", "2024-01-31 12:00:00"),
    ]
    assert [r.talent_id for r in plan.without_user(df).collect()] == [4]
