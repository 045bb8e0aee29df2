"""Recommendation: per-evidence preferences, the combined category, and the request bodies."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_analytics.plans import recommend as plan

from .tables import AS_OF, SHIFT_AS_OF, day_text, recommend_tables, ts_text, with_tables

RUN_TS = "2024-01-31 12:00:00"


def _talents(t, listed=plan.talent_list):
    return listed(t["talent_eligibility"], t["dim_talent"], AS_OF)


def _revenue(t, parity=True, talents=None):
    return plan.unfulfilled_revenue(
        t["fact_shift"], t["fact_job"], t["dim_job_category"], t["dim_business_region"],
        _talents(t) if talents is None else talents, SHIFT_AS_OF, parity=parity,
    )


def unfulfilled_revenue(spark, d):
    return _revenue(recommend_tables(spark, d))


def unfulfilled_revenue_once(spark, d):
    return _revenue(recommend_tables(spark, d), parity=False)


def eligible_preference(spark, d):
    return _eligible(recommend_tables(spark, d))


def _eligible(t):
    talents = _talents(t, plan.stored_talent_list)
    return plan.eligible_preference(talents, _revenue(t, talents=talents))


def worked_category(spark, d):
    t = recommend_tables(spark, d)
    out = plan.worked_category(_talents(t), t["fact_shift"], t["fact_job"], t["dim_job_category"])
    return out.withColumns({c: day_text(c) for c in ("max_shift_category", "last_booked_shift")})


def _preference(kind, ranked=False):
    def run(spark, d):
        t = recommend_tables(spark, d)
        fn, table = {
            "applied": (plan.applied_preference, "job_apply_core"),
            "seen": (plan.seen_preference, "job_details_seen"),
        }[kind]
        talents = _talents(t, plan.stored_talent_list)
        if ranked:  # as if every user were shared: all rows are ranked
            talents = talents.withColumn("shared", F.lit(True))
        out = fn(talents, t[table], t["fact_job"], t["dim_job_category"], AS_OF)
        return out.withColumn(f"last_{kind}_job", ts_text(f"last_{kind}_job"))

    return run


def _shared_tables(spark, d):
    """Several talents to most users, and some talents without one."""
    tables = recommend_tables(spark, d)
    user = F.concat(F.lit("u"), (F.col("talent_id") % 199).cast("string"))
    talents = tables["dim_talent"].withColumn("user_uuid", F.when(F.col("talent_id") % 11 != 0, user))
    return {**tables, "dim_talent": talents}


def recommend_category_shared_users(spark, d):
    return plan.recommend_category(_shared_tables(spark, d), AS_OF, SHIFT_AS_OF)


def eligible_preference_shared_users(spark, d):
    return _eligible(_shared_tables(spark, d))


def recommend_category(spark, d):
    return plan.recommend_category(recommend_tables(spark, d), AS_OF, SHIFT_AS_OF)


def recommendation_payloads(spark, d):
    t = recommend_tables(spark, d)
    links = t["dim_job_category"].select(
        F.col("job_category_name").alias("job_category"),
        F.when(F.col("job_category_id") % 5 != 0, F.concat(F.lit("key-"), F.lower("job_category_name"))).alias(
            "category_key"
        ),
    )
    return plan.recommendation_payloads(recommend_category(spark, d), links, RUN_TS)


QUERIES = {
    "unfulfilled_revenue": unfulfilled_revenue,
    "unfulfilled_revenue_once": unfulfilled_revenue_once,
    "eligible_preference": eligible_preference,
    "worked_category": worked_category,
    "applied_preference": _preference("applied"),
    "seen_preference": _preference("seen"),
    "applied_preference_ranked": _preference("applied", ranked=True),
    "seen_preference_ranked": _preference("seen", ranked=True),
    "recommend_category": recommend_category,
    "recommend_category_shared_users": recommend_category_shared_users,
    "eligible_preference_shared_users": eligible_preference_shared_users,
    "recommendation_payloads": recommendation_payloads,
}

# The oracle ranks and counts all rows in windows and joins revenue to every talent before summing.
STAGES = {
    "talents_today": f"""
    SELECT DISTINCT e.eligible_matched_talent AS talent, t.user_uuid, t.employment_city AS city,
           t.matching_region_name AS region, e.matched_tag AS tag
    FROM talent_eligibility e LEFT JOIN dim_talent t ON t.talent_id = e.eligible_matched_talent
    WHERE e.date_dt = DATE '{AS_OF}'""",
    "worked_days": """
    SELECT DISTINCT p.talent, p.user_uuid, c.job_category_name AS category, s.shift_dt, p.tag
    FROM talents_today p, fact_shift s, fact_job j, dim_job_category c
    WHERE s.booked_shift_talent_id = p.talent AND j.job_id = s.job_fk
      AND j.mandatory_include_tags = p.tag AND c.job_category_id = s.job_category_fk""",
    "worked_ranked": """
    SELECT *, max(shift_dt) OVER by_category AS category_last,
           rank() OVER (PARTITION BY talent, category ORDER BY shift_dt DESC NULLS FIRST) AS recency,
           count(shift_dt) OVER by_category AS days, max(shift_dt) OVER (PARTITION BY talent) AS talent_last
    FROM worked_days WINDOW by_category AS (PARTITION BY talent, category)""",
    "worked_stage": "SELECT * FROM worked_ranked WHERE category_last = talent_last AND recency = 1",
    "applied_rows": f"""
    SELECT p.talent, p.user_uuid, p.tag, c.job_category_name AS category, a.job_uuid, a."timestamp" AS stamp,
           rank() OVER (PARTITION BY a.talent_uuid ORDER BY a."timestamp" DESC NULLS FIRST) AS position
    FROM talents_today p, job_apply_core a, fact_job j, dim_job_category c
    WHERE a.talent_uuid = p.user_uuid AND j.job_uuid = a.job_uuid AND j.mandatory_include_tags = p.tag
      AND c.job_category_id = j.job_category_fk
      AND a."timestamp" BETWEEN DATE '{AS_OF}' - 60 AND DATE '{AS_OF}' + 1""",
    "seen_rows": f"""
    SELECT p.talent, p.user_uuid, p.tag, c.job_category_name AS category, v.job_uuid,
           v.last_job_details_seen AS stamp,
           rank() OVER (PARTITION BY v.talent_uuid ORDER BY v.last_job_details_seen ASC NULLS LAST,
                        v.job_details_seen_count DESC NULLS FIRST) AS position
    FROM talents_today p, job_details_seen v, fact_job j, dim_job_category c
    WHERE v.talent_uuid = p.user_uuid AND j.job_uuid = v.job_uuid AND j.mandatory_include_tags = p.tag
      AND c.job_category_id = j.job_category_fk
      AND v.last_job_details_seen BETWEEN DATE '{AS_OF}' - 60 AND DATE '{AS_OF}' + 1""",
    **{
        f"{kind}_stage": f"""
    SELECT * FROM (
    SELECT *, CASE WHEN owned = position THEN category END AS marker,
           CASE WHEN rows_left = 1 THEN 1 END AS single
    FROM (SELECT *, dense_rank() OVER (PARTITION BY talent ORDER BY same_kind DESC NULLS FIRST) AS popularity,
                 count(user_uuid) OVER (PARTITION BY talent) AS rows_left
          FROM (SELECT DISTINCT talent, user_uuid, tag, category, position,
                       count(category) OVER (PARTITION BY talent) AS owned,
                       count(job_uuid) OVER (PARTITION BY talent, category, tag) AS same_kind,
                       max(stamp) OVER (PARTITION BY talent) AS last_stamp
                FROM {kind}_rows)))
    WHERE coalesce(category = marker, FALSE) OR coalesce(single = 1, FALSE)"""
        for kind in ("applied", "seen")
    },
    "revenue_once": f"""
    SELECT s.business_region, r.matching_region_name, c.job_category_name, j.mandatory_include_tags,
           CAST(sum(s.ordered_revenue_value - s.booked_revenue_value) AS DOUBLE) AS unfulfilled_revenue
    FROM fact_shift s LEFT JOIN fact_job j ON j.job_id = s.job_fk
         LEFT JOIN dim_job_category c ON c.job_category_id = j.job_category_fk
         LEFT JOIN dim_business_region r ON r.business_region_name = s.business_region
    WHERE s.shift_dt BETWEEN DATE '{SHIFT_AS_OF}' AND DATE '{SHIFT_AS_OF}' + 3
      AND r.matching_region_name IN (SELECT region FROM talents_today)
    GROUP BY ALL""",
    "revenue_stage": f"""
    SELECT s.business_region, r.matching_region_name, c.job_category_name, j.mandatory_include_tags,
           CAST(sum(s.ordered_revenue_value - s.booked_revenue_value) AS DOUBLE) AS unfulfilled_revenue
    FROM fact_shift s LEFT JOIN fact_job j ON j.job_id = s.job_fk
         LEFT JOIN dim_job_category c ON c.job_category_id = j.job_category_fk
         LEFT JOIN dim_business_region r ON r.business_region_name = s.business_region
         JOIN talents_today p ON p.region = r.matching_region_name
    WHERE s.shift_dt BETWEEN DATE '{SHIFT_AS_OF}' AND DATE '{SHIFT_AS_OF}' + 3
    GROUP BY ALL""",
    "eligible_stage": """
    SELECT *, rank() OVER (PARTITION BY user_uuid ORDER BY unfulfilled_revenue DESC NULLS FIRST) AS place
    FROM (SELECT DISTINCT p.talent, p.user_uuid, p.city, p.region, g.job_category_name AS category,
                 g.unfulfilled_revenue
          FROM talents_today p JOIN revenue_stage g ON g.matching_region_name = p.region
          WHERE g.unfulfilled_revenue > 0)
    QUALIFY place = 1""",
    "recommended_stage": """
    SELECT DISTINCT p.talent AS talent_id, p.user_uuid, p.region AS matching_region_name,
           p.city AS employment_city,
           coalesce(a.marker, w.category, s.marker, e.category) AS job_category_key
    FROM talents_today p LEFT JOIN worked_stage w USING (talent) LEFT JOIN applied_stage a USING (talent)
         LEFT JOIN seen_stage s USING (talent) LEFT JOIN eligible_stage e USING (talent)""",
}


def _preference_sql(kind):
    return with_tables(
        f"""SELECT talent AS eligible_matched_talent, user_uuid, owned AS cnt_shifts, same_kind AS {kind}_count,
        popularity AS ranking_by_cnt, marker AS {kind}_preference, category AS job_category_name,
        tag AS matched_tag, strftime(last_stamp, '%Y-%m-%d %H:%M:%S.%f') AS last_{kind}_job,
        single AS total_selected_row FROM {kind}_stage""",
        STAGES,
    )


_SHARED = {
    **STAGES,
    "dim_talent": """
    SELECT c_custkey AS talent_id, CASE WHEN c_custkey % 11 <> 0 THEN 'u' || c_custkey % 199 END AS user_uuid,
           n_name AS employment_city, r_name AS matching_region_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}
_ELIGIBLE = """SELECT talent AS eligible_matched_talent, user_uuid, city AS employment_city,
    region AS matching_region_name, category AS eligible_preference, unfulfilled_revenue,
    place AS eligible_ranking FROM eligible_stage"""

ORACLE = {
    "unfulfilled_revenue": with_tables("SELECT * FROM revenue_stage", STAGES),
    "unfulfilled_revenue_once": with_tables("SELECT * FROM revenue_once", STAGES),
    "eligible_preference": with_tables(_ELIGIBLE, STAGES),
    "eligible_preference_shared_users": with_tables(_ELIGIBLE, _SHARED),
    "worked_category": with_tables(
        """SELECT DISTINCT talent AS eligible_matched_talent, user_uuid, category AS working_preference,
        CAST(category_last AS VARCHAR) AS max_shift_category, recency AS rnk_shifts, days AS working_count,
        tag AS matched_tag, CAST(talent_last AS VARCHAR) AS last_booked_shift FROM worked_stage""",
        STAGES,
    ),
    "applied_preference": _preference_sql("applied"),
    "seen_preference": _preference_sql("seen"),
    "applied_preference_ranked": _preference_sql("applied"),
    "seen_preference_ranked": _preference_sql("seen"),
    "recommend_category": with_tables("SELECT * FROM recommended_stage", STAGES),
    "recommend_category_shared_users": with_tables("SELECT * FROM recommended_stage", _SHARED),
    "recommendation_payloads": with_tables(
        f"""
    SELECT 0 AS shard, batch_no, count(*) AS records,
           CAST(to_json({{'attributes': list({{'external_id': user_uuid, 'rca_job_category': job_category_key,
               'rca_deep_link': 'app://offers/home/feed=short_term' || CASE WHEN job_category_id % 5 <> 0
                   THEN '&category=key-' || lower(job_category_key) ELSE '' END,
               'is_rca_date': '{RUN_TS}'}} ORDER BY seat)}}) AS VARCHAR) AS payload
    FROM (SELECT *, row_number() OVER (ORDER BY bucket, k) AS seat,
                 (row_number() OVER (ORDER BY bucket, k) - 1) // 50 AS batch_no
          FROM (SELECT *, CAST(('0x' || substr(sha256(k), 1, 8))::BIGINT % 65536 AS INTEGER) AS bucket
                FROM (SELECT *, concat_ws('|', user_uuid, job_category_key) AS k
                      FROM recommended_stage LEFT JOIN dim_job_category
                           ON job_category_name = job_category_key
                      WHERE user_uuid IS NOT NULL)))
    GROUP BY batch_no""",
        STAGES,
    ),
}
