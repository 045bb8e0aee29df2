"""Category recommendation: one job category per eligible talent, and its request bodies.

A talent's category comes from the shifts they worked, the jobs they applied for, the jobs they
looked at, and the revenue still unfilled in their region. Category names are not null.

Activity belongs to users, and its ranks run over all rows of a user, while counts run over those of a talent.
Mostly users and talents identify each other, and then the last rank is found by two aggregations. Where several
talents share a user, or a talent has several users, every row of these users is ranked. ``mark_shared`` tells
the two apart by the data; nothing has to be declared.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import within_days
from ..operators.filters import positive_only, snapshot
from ..operators.joins import enrich_left, join_id_and_tag, join_measured, map_lookup
from ..operators.ordering import order_key
from ..operators.payloads import batch_payloads
from ..operators.windows import dense_rank_over, last_rank_marker, max_over, qualify, spread_rank, tail_marker
from ..sources.sinks import materialize

TALENT = "eligible_matched_talent"

# Days of activity looked back on and ahead, days of open shifts looked ahead on.
ACTIVITY_BACK, ACTIVITY_FORWARD, REVENUE_FORWARD = 60, 1, 3


def talent_list(eligibility: DataFrame, talents: DataFrame, as_of: str) -> DataFrame:
    """Eligible talents of the day with their user, city, region and tag."""
    listed = snapshot(eligibility, as_of).select("date_dt", TALENT, "matched_tag")
    known = talents.select("talent_id", "user_uuid", "employment_city", "matching_region_name")
    rows = enrich_left(listed, known, TALENT, "talent_id")
    return rows.select(
        "date_dt", TALENT, "user_uuid", "employment_city", "matching_region_name", "matched_tag"
    ).distinct()


def stored_talent_list(eligibility: DataFrame, talents: DataFrame, as_of: str) -> DataFrame:
    """``talent_list`` as a table, for plans that use it more than once."""
    return materialize(talent_list(eligibility, talents, as_of), "talents")


def mark_shared(talents: DataFrame) -> DataFrame:
    """Add ``shared``: whether the row's user has several talents or regions, or one of their talents several users.

    Talents without a user but with a region count as sharing one. Where nobody shares, which one count looks up here,
    there is no such column, and plans for shared users are not made. Where somebody does, the flagged talents are
    written once.
    """
    if "shared" in talents.columns:
        return talents
    pairs = talents.select(TALENT, "user_uuid", "matching_region_name")
    pairs = pairs.where("user_uuid IS NOT NULL OR matching_region_name IS NOT NULL").distinct()
    # Every talent, user and region stand together once only if each talent and each user does.
    user = F.struct("user_uuid")
    n = pairs.agg(F.count("*").alias("all"), F.count_distinct(TALENT).alias("talents"), F.count_distinct(user).alias("users")).first()
    if n["all"] == n.talents == n.users:
        return talents

    def several(col: str) -> Column:
        return F.min(col) < F.max(col)

    by_user = several(TALENT) | several("matching_region_name")
    users = pairs.groupBy("user_uuid").agg(by_user.alias("several")).where("several").select("user_uuid")
    owners = pairs.groupBy(TALENT).agg(several("user_uuid").alias("several")).where("several").select(TALENT)
    found = users.unionByName(pairs.join(owners, TALENT, "left_semi").select("user_uuid")).distinct()
    flagged = found.select(F.col("user_uuid").alias("_user"), F.lit(True).alias("_shared"))
    joined = talents.join(flagged, F.col("user_uuid").eqNullSafe(F.col("_user")), "left").drop("_user")
    return materialize(joined.withColumn("shared", F.col("_shared").isNotNull()).drop("_shared"), "flagged-talents")


def _names(categories: DataFrame) -> DataFrame:
    return categories.select("job_category_id", "job_category_name")


def worked_category(
    talents: DataFrame, shifts: DataFrame, jobs: DataFrame, categories: DataFrame
) -> DataFrame:
    """Category of each talent's latest shift, with how often they worked in it.

    Shifts count once per day and tag. They are reduced to one row per talent, category and tag
    before any window, so the windows see no more rows than there are categories and tags.
    """
    booked = talents.select(TALENT, "user_uuid", "matched_tag").join(
        shifts.select("booked_shift_talent_id", "job_fk", "job_category_fk", "shift_dt"),
        F.col(TALENT) == F.col("booked_shift_talent_id"),
    )
    tagged = join_id_and_tag(booked, jobs.select("job_id", "mandatory_include_tags"), "job_fk", "job_id")
    named = tagged.join(_names(categories), F.col("job_category_fk") == F.col("job_category_id")).select(
        TALENT, "user_uuid", "matched_tag", "job_category_name", "shift_dt"
    )
    per_tag = named.groupBy(TALENT, "user_uuid", "job_category_name", "matched_tag").agg(
        F.count_distinct("shift_dt").alias("days"),
        F.max("shift_dt").alias("latest"),
        F.bool_or(F.col("shift_dt").isNull()).alias("undated"),
    )
    of_category = Window.partitionBy(TALENT, "job_category_name")
    ranked = per_tag.withColumns(
        {
            "max_shift_category": max_over([TALENT, "job_category_name"], "latest"),
            "last_booked_shift": max_over([TALENT], "latest"),
            "working_count": F.sum("days").over(of_category),
            "any_undated": F.bool_or("undated").over(of_category),
        }
    )
    # Rank 1 of a descending date is an undated row where there is one, else the latest date.
    first = F.when(F.col("any_undated"), F.col("undated")).otherwise(
        F.col("latest") == F.col("max_shift_category")
    )
    kept = qualify(ranked, (F.col("max_shift_category") == F.col("last_booked_shift")) & first)
    return kept.select(
        TALENT,
        "user_uuid",
        F.col("job_category_name").alias("working_preference"),
        "max_shift_category",
        F.lit(1).cast("bigint").alias("rnk_shifts"),
        "working_count",
        "matched_tag",
        "last_booked_shift",
    )


def activity_jobs(
    talents: DataFrame,
    activity: DataFrame,
    jobs: DataFrame,
    categories: DataFrame,
    stamp: str,
    as_of: str,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Applications or views of the last 60 days, by talents whose tag the job asks for."""
    recent = activity.where(within_days(F.col(stamp), as_of, ACTIVITY_BACK, ACTIVITY_FORWARD)).select(
        "talent_uuid", "job_uuid", stamp, *extra
    )
    flag = [c for c in ("shared",) if c in talents.columns]
    owned = talents.select(TALENT, "user_uuid", "matched_tag", *flag).join(
        recent, F.col("user_uuid") == F.col("talent_uuid")
    )
    wanted = jobs.select("job_uuid", "mandatory_include_tags", "job_category_fk")
    tagged = join_id_and_tag(owned, wanted, "job_uuid", "job_uuid")
    return tagged.join(_names(categories), F.col("job_category_fk") == F.col("job_category_id")).drop(
        "job_category_fk", "job_category_id"
    )


def _facts(table: DataFrame, kind: str, stamp: str, order: list[str]) -> DataFrame:
    """Applications or views in one form; the fact ranked last has the greatest ``order_key``."""
    return table.select(
        "talent_uuid",
        "job_uuid",
        F.lit(kind).alias("kind"),
        F.col(stamp).alias("stamp"),
        order_key(table, *order).alias("order_key"),
    )


def applied_facts(applications: DataFrame) -> DataFrame:
    """Applications, ranked by descending time: the oldest comes last."""
    return _facts(applications, "applied", "timestamp", ["-timestamp"])


def seen_facts(views: DataFrame) -> DataFrame:
    """Views, ranked by time and, at equal times, descending count: the least repeated of the latest comes last."""
    columns = ["last_job_details_seen", "-job_details_seen_count"]
    return _facts(views, "seen", "last_job_details_seen", columns)


def _preferences(
    marked: DataFrame, facts: list[DataFrame], jobs: DataFrame, categories: DataFrame, as_of: str
) -> DataFrame:
    """For each kind of facts, the category of every talent's last-ranked one, from the talents of ``mark_shared``.

    All kinds go through the same joins and aggregates. Columns: the talent, ``user_uuid``, ``kind``, ``cnt`` facts
    of the talent, ``group_cnt`` of them with this category and tag, its dense rank ``popularity``, ``preference``
    (null where the only entry does not come last), ``job_category_name``, ``matched_tag``, ``last_stamp``, ``single``.
    """
    rows = activity_jobs(marked, reduce(DataFrame.unionByName, facts), jobs, categories, "stamp", as_of, ("kind", "order_key"))
    if "shared" not in marked.columns:
        return _by_tail(rows)
    return _by_tail(rows.where("NOT shared")).unionByName(materialize(_by_rank(rows.where("shared")), "shared-preferences"))


def _by_tail(rows: DataFrame) -> DataFrame:
    ranked = tail_marker(rows, [TALENT, "kind"], ["user_uuid", "matched_tag", "job_category_name"], "order_key", "stamp")
    return qualify(ranked, F.col("is_tail") | F.col("single")).select(
        TALENT,
        "user_uuid",
        "kind",
        "cnt",
        "group_cnt",
        "popularity",
        F.when(F.col("is_tail"), F.col("job_category_name")).alias("preference"),
        "job_category_name",
        "matched_tag",
        "last_stamp",
        F.when(F.col("single"), F.lit(1)).alias("single"),
    )


def _by_rank(rows: DataFrame) -> DataFrame:
    """The same from the rank of every row in its user and the row count of its talent.

    Rows that agree in all that matters are counted first, so that ranks run over counts. The counts and the ranks
    are each used several times and therefore written.
    """
    job = [TALENT, "kind", "job_category_name", "matched_tag"]
    of_talent = Window.partitionBy(TALENT, "kind")
    counted = rows.groupBy(*job, "user_uuid", "order_key").agg(F.count("*").alias("n"), F.max("stamp").alias("stamp"))
    counted = materialize(counted, "shared-activity")
    per_job = (
        counted.groupBy(*job)
        .agg(F.sum("n").alias("group_cnt"), F.max("stamp").alias("s"))
        .select(
            *job,
            "group_cnt",
            F.sum("group_cnt").over(of_talent).alias("cnt"),
            dense_rank_over([TALENT, "kind"], [F.col("group_cnt").desc_nulls_first()]).alias("popularity"),
            F.max("s").over(of_talent).alias("last_stamp"),
        )
    )
    ranked = spread_rank(counted, ["user_uuid", "kind"], "order_key", "n")
    listed = materialize(ranked.select(*job, "user_uuid", "rnk").distinct(), "shared-ranks")
    single = listed.groupBy(TALENT, "kind").agg(F.count("*").alias("left")).where("left = 1")
    single = single.select(TALENT, "kind", F.lit(1).alias("single"))
    marker = last_rank_marker(F.col("cnt"), F.col("rnk"), F.col("job_category_name"))
    marked = listed.join(per_job, job).join(single, [TALENT, "kind"], "left").withColumn("preference", marker)
    return qualify(marked, F.col("preference").isNotNull() | F.col("single").isNotNull()).select(
        TALENT,
        "user_uuid",
        "kind",
        "cnt",
        "group_cnt",
        "popularity",
        "preference",
        "job_category_name",
        "matched_tag",
        "last_stamp",
        "single",
    )


def _named(found: DataFrame, kind: str) -> DataFrame:
    return found.select(
        TALENT,
        "user_uuid",
        F.col("cnt").alias("cnt_shifts"),
        F.col("group_cnt").alias(f"{kind}_count"),
        F.col("popularity").alias("ranking_by_cnt"),
        F.col("preference").alias(f"{kind}_preference"),
        "job_category_name",
        "matched_tag",
        F.col("last_stamp").alias(f"last_{kind}_job"),
        F.col("single").alias("total_selected_row"),
    )


def applied_preference(
    talents: DataFrame, applications: DataFrame, jobs: DataFrame, categories: DataFrame, as_of: str
) -> DataFrame:
    """Category of the application ranked last by recency, which is the oldest one of a user of their own."""
    return _named(_preferences(mark_shared(talents), [applied_facts(applications)], jobs, categories, as_of), "applied")


def seen_preference(
    talents: DataFrame, views: DataFrame, jobs: DataFrame, categories: DataFrame, as_of: str
) -> DataFrame:
    """Category of the view ranked last: the latest one, and of equal times the least repeated."""
    return _named(_preferences(mark_shared(talents), [seen_facts(views)], jobs, categories, as_of), "seen")


def unfulfilled_revenue(
    shifts: DataFrame,
    jobs: DataFrame,
    categories: DataFrame,
    regions: DataFrame,
    talents: DataFrame,
    as_of: str,
    days: int = REVENUE_FORWARD,
    parity: bool = True,
) -> DataFrame:
    """Ordered minus booked revenue of the coming days by region, category and tag.

    The report counts every shift once per talent of the region. That fan-out is not built: the
    sum of copies equals the sum times the number of talents, so both are aggregated first.
    ``parity=False`` leaves the factor out.
    """
    gap = F.col("ordered_revenue_value") - F.col("booked_revenue_value")
    per_job = (
        shifts.where(within_days(F.col("shift_dt"), as_of, 0, days))
        .groupBy("job_fk", "business_region")
        .agg(F.sum(gap).alias("gap"))
    )
    per_fk = (
        per_job.join(
            jobs.select("job_id", "job_category_fk", "mandatory_include_tags"), F.col("job_fk") == F.col("job_id"), "left"
        )
        .groupBy("business_region", "job_category_fk", "mandatory_include_tags")
        .agg(F.sum("gap").alias("gap"))
    )
    named = enrich_left(per_fk, _names(categories), "job_category_fk", "job_category_id")
    places = regions.select("business_region_name", "matching_region_name")
    placed = enrich_left(named, places, "business_region", "business_region_name")
    totals = placed.groupBy(
        "business_region", "matching_region_name", "job_category_name", "mandatory_include_tags"
    ).agg(F.sum("gap").alias("gap"))
    crowd = talents.groupBy("matching_region_name").agg(F.count("*").alias("talents"))
    factor = F.col("talents") if parity else F.lit(1)
    return totals.join(crowd, "matching_region_name").select(
        "business_region",
        "matching_region_name",
        "job_category_name",
        "mandatory_include_tags",
        (F.col("gap") * factor).cast("double").alias("unfulfilled_revenue"),
    )


def _best_of_region(revenue: DataFrame) -> DataFrame:
    """A region's categories of greatest unfilled revenue, as a small table of their own."""
    top = Window.partitionBy("matching_region_name")
    best = (
        positive_only(revenue, "unfulfilled_revenue")
        .withColumn("top", F.max("unfulfilled_revenue").over(top))
        .where(F.col("unfulfilled_revenue") == F.col("top"))
        .select("matching_region_name", "job_category_name", "unfulfilled_revenue")
        .distinct()
    )
    return materialize(best, "best-of-region")


def _offers(talents: DataFrame, best: DataFrame) -> DataFrame:
    """Talents with their region's best categories, unless their user has a better one elsewhere."""
    columns = [TALENT, "user_uuid", "employment_city", "matching_region_name", *(c for c in talents.columns if c == "shared")]
    offers = join_measured(talents.select(*columns).distinct(), best, "matching_region_name")
    if "shared" not in columns:
        return offers
    tops = offers.where("shared").groupBy(F.col("user_uuid").alias("_user")).agg(F.max("unfulfilled_revenue").alias("_top"))
    joined = offers.join(tops, F.col("shared") & F.col("user_uuid").eqNullSafe(F.col("_user")), "left")
    return joined.where("_top IS NULL OR unfulfilled_revenue = _top").drop("_user", "_top", "shared")


def eligible_preference(talents: DataFrame, revenue: DataFrame) -> DataFrame:
    """Category with the greatest unfilled revenue in each user's region, ties kept.

    Only a region's best categories can be a user's best ones, so every region is cut down to those before it meets
    its talents, which stay where they are.
    """
    with ThreadPoolExecutor(1) as aside:  # two jobs that do not need each other
        best = aside.submit(_best_of_region, revenue)
        offers = _offers(mark_shared(talents), best.result())
    return offers.select(
        TALENT,
        "user_uuid",
        "employment_city",
        "matching_region_name",
        F.col("job_category_name").alias("eligible_preference"),
        "unfulfilled_revenue",
        F.lit(1).cast("bigint").alias("eligible_ranking"),
    )


def _with_offer(talents: DataFrame, best: DataFrame) -> DataFrame:
    """Every talent with ``offered``, the categories that ``eligible_preference`` gives them; null without one."""
    alone = talents.where("NOT shared") if "shared" in talents.columns else talents
    alone = join_measured(alone, best, "matching_region_name", "left").withColumnRenamed("job_category_name", "offered")
    if "shared" not in talents.columns:
        return alone
    sharing = talents.where("shared")
    offers = _offers(sharing, best).select(TALENT, F.col("job_category_name").alias("offered")).distinct()
    offers = materialize(offers, "shared-offers")
    return alone.select(*talents.columns, "offered").unionByName(sharing.join(offers, TALENT, "left"))


# Which evidence counts first. Unfilled revenue comes after all of them.
PRIORITY = {"applied": 1, "worked": 2, "seen": 3}


def best_evidence(activity: DataFrame, worked: DataFrame) -> DataFrame:
    """The categories of every talent's strongest kind of evidence: the talent and ``category``, ties kept."""
    rank = F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])
    found = activity.where("preference IS NOT NULL").select(
        TALENT, rank[F.col("kind")].alias("priority"), F.col("preference").alias("category")
    )
    booked = worked.select(TALENT, F.lit(PRIORITY["worked"]).alias("priority"), F.col("working_preference").alias("category"))
    both = found.unionByName(booked)
    ranked = both.withColumn("best", F.min("priority").over(Window.partitionBy(TALENT)))
    return ranked.where("priority = best").select(TALENT, "category").distinct()


def recommend_category(
    tables: dict[str, DataFrame],
    as_of: str,
    shift_as_of: str | None = None,
    parity: bool = True,
) -> DataFrame:
    """One category per eligible talent, from the warehouse tables named as in ``tables``; ties give several rows.

    The talents of the day and the best categories of every region are written once and read where they are needed.
    Applications and views share their joins, and evidence of all kinds meets in one union that keeps the strongest.
    """
    jobs, categories = tables["fact_job"], tables["dim_job_category"]
    listed = stored_talent_list(tables["talent_eligibility"], tables["dim_talent"], as_of)
    revenue = unfulfilled_revenue(
        tables["fact_shift"],
        jobs,
        categories,
        tables["dim_business_region"],
        listed,
        shift_as_of or as_of,
        parity=parity,
    )
    facts = [applied_facts(tables["job_apply_core"]), seen_facts(tables["job_details_seen"])]
    with ThreadPoolExecutor(1) as aside:  # the regions' best categories are found while the talents' evidence is prepared
        best = aside.submit(_best_of_region, revenue)
        talents = mark_shared(listed)
        evidence = best_evidence(
            _preferences(talents, facts, jobs, categories, as_of),
            worked_category(talents, tables["fact_shift"], jobs, categories),
        )
        offers = _with_offer(talents, best.result())
    return offers.join(evidence, TALENT, "left").select(
        F.col(TALENT).alias("talent_id"),
        "user_uuid",
        "matching_region_name",
        "employment_city",
        F.coalesce("category", "offered").alias("job_category_key"),
    ).distinct()


def recommendation_payloads(
    recommended: DataFrame,
    deep_links: DataFrame,
    run_ts: str,
    base_url: str = "app://offers/home/feed=short_term",
    size: int = 50,
    shards: int | None = None,
) -> DataFrame:
    """Profile updates with category, deep link and run time, in bodies of at most 50 users.

    Talents without a user cannot be addressed: they are in ``without_user`` and in no body.
    """
    keyed = deep_links.withColumn(
        "_suffix",
        F.when(
            F.coalesce(F.col("category_key"), F.lit("")) != "",
            F.concat(F.lit(f"{base_url}&category="), F.col("category_key")),
        ),
    )
    addressed = recommended.where("user_uuid IS NOT NULL")
    linked = map_lookup(
        addressed, "job_category_key", keyed, "job_category", "_suffix", "deep_link", F.lit(base_url)
    ).withColumn("_key", F.concat_ws("|", "user_uuid", "job_category_key"))
    record = F.struct(
        F.col("user_uuid").alias("external_id"),
        F.col("job_category_key").alias("rca_job_category"),
        F.col("deep_link").alias("rca_deep_link"),
        F.lit(run_ts).alias("is_rca_date"),
    )
    if shards is None:
        # Numbering reads its input twice; the recommendation is computed once.
        linked = materialize(linked.select("_key", "user_uuid", "job_category_key", "deep_link"), "payload-rows")
    return batch_payloads(linked, "_key", record, "attributes", size, shards)


def without_user(recommended: DataFrame) -> DataFrame:
    """Recommendations that no body carries, as their talent has no user."""
    return recommended.where("user_uuid IS NULL")
