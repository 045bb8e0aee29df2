"""Shape of the physical plans: no Python workers, no pairwise joins, pruned and filtered scans."""

import re

import pytest

from pyspark.sql import functions as F

import registry
from campaign_analytics.operators import sets
from campaign_analytics.operators.payloads import batch_payloads
from campaign_analytics.plans import reporting
from registry import reports, tables

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in QUERIES if not k.startswith("stream_")])
def test_plan_stays_in_the_engine(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_scans_are_pruned_and_filtered(spark):
    costs = tables.report_tables(spark, SF_DIR)["channel_cost"]
    plan = plan_of(reporting.report_costs(costs, reports.START, reports.END, ["brand#1"], []).select("date_dt", "clicks"))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    lineitem = next(s for s in scans if "l_partkey" in s[0])
    assert {c.split("#")[0] for c in lineitem[0].split(",")} == {"l_partkey", "l_linenumber", "l_shipdate"}
    orders = tables.star_tables(spark, SF_DIR)["company_order"]
    assert "GreaterThanOrEqual" in plan_of(reports.readers.scan_between(orders, "created_dt", "1998-01-01", "1998-02-01"))


def test_revenue_is_reduced_before_it_meets_talents(spark):
    plan = plan_of(QUERIES["unfulfilled_revenue"](spark, SF_DIR))
    assert plan.index("Join") < plan.index("partial_sum")
    assert plan.count("partial_count") >= 1


def test_windows_of_the_default_path_see_no_facts(spark):
    """Ranking runs over rows already reduced to one per talent, user, tag and category."""
    for key in ("applied_preference", "seen_preference"):
        plan = plan_of(QUERIES[key](spark, SF_DIR))
        assert plan.rindex("Window [") < plan.index("partial_count(1)")


@pytest.mark.parametrize("key", ["recommend_category", "recommend_category_shared_users"])
def test_recommendation_reads_and_shuffles_little(spark, key):
    plan = plan_of(QUERIES[key](spark, "/root/testdata/sf0.01"))
    assert plan.count("FileScan") <= 20
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 12


def test_talents_are_not_gathered_by_region(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["eligible_preference"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(matching_region_name" not in plan
    assert "BroadcastHashJoin" in plan


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["bonus_program", "review_decisions", "first_touch", "latest_attributes", "job_view"])
def test_no_row_is_carried_through_a_sorted_aggregate(spark, no_broadcasts, key):
    assert "SortAggregate" not in plan_of(QUERIES[key](spark, SF_DIR))


def test_descriptions_are_shuffled_once(spark, no_broadcasts):
    """Jobs are found by id and number alone; the text moves in one exchange, and generic requests meet no job."""
    plan = plan_of(QUERIES["job_view"](spark, SF_DIR))
    exchanges = re.split(r"Exchange hashpartitioning", plan)[1:]
    # What an exchange reads stands right below it; the text is made from the title's columns in a projection.
    carrying = [e for e in exchanges if "<p>Job" in e.split("Exchange")[0].split("FileScan")[0]]
    assert len(carrying) == 1
    assert plan.count("Join ") <= 2


def test_group_assignment_moves_no_rows(spark):
    assert "Exchange" not in plan_of(QUERIES["assign_groups"](spark, SF_DIR))


def test_a_page_keeps_only_its_top_rows(spark):
    assert "TakeOrderedAndProject" in plan_of(sets.page_of(spark.range(100), "id", page=3))


def test_batches_need_one_shuffle(spark):
    keys = spark.range(100).select(F.col("id").cast("string").alias("id"))
    assert plan_of(batch_payloads(keys, "id", F.struct("id"), "users", shards=4)).count("Exchange") == 1
