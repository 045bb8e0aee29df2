"""Job feed, job views, board listings, bonus programs and review decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_analytics.plans import feeds as plan
from campaign_analytics.plans import reviews
from campaign_analytics.session import shared_dir
from campaign_analytics.sources import jobs as job_source
from campaign_analytics.sources import sinks

from .tables import by_index, read, sql_index, with_tables

COMPANY = "Example GmbH"
LANGUAGES = ["de", "en", None]
DAVS = [None, "x", "", None]

SQL = {
    "feed_rows": f"""
    SELECT CASE o_orderstatus WHEN 'O' THEN 'LIVE' WHEN 'F' THEN 'DRAFT' ELSE 'INACTIVE' END AS status,
           'R' || o_custkey AS referencenumber, o_orderpriority || ' <b>&' AS title,
           strftime(o_orderdate, '%Y-%m-%d') AS date, 'City ' || (o_custkey % 25) AS city,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS salary,
           'https://e.com/job?id=' || o_orderkey || '&x=1' AS url, 'MINIJOB' AS jobtype,
           {sql_index(LANGUAGES, "o_orderkey % 3")} AS language, 'Cat ' || (o_orderkey % 6) AS category,
           '<p>Job ' || o_orderkey || ' für "alle"</p>' AS description,
           strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS end_day, o_orderkey AS row_no
    FROM orders""",
    "view_requests": f"""
    SELECT event_id AS request_id, CASE WHEN event_id % 5 <> 0 THEN 'R' || (user_id * 11) END AS job_id,
           CASE WHEN event_id % 4 = 2 THEN CAST(event_id * 2 AS VARCHAR)
                ELSE {sql_index(DAVS, "event_id % 4")} END AS dav FROM events""",
    "bonus_rows": """
    SELECT 'B' || s_nationkey AS id, s_suppkey AS row_no, '50 EUR' AS bonus, CAST(s_suppkey % 9 AS VARCHAR) AS shifts,
           s_name AS city, 'Terms ' || s_suppkey AS terms FROM supplier""",
}


def feed_rows(spark, d):
    key = F.col("o_orderkey")
    return read(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "O", "LIVE")
        .when(F.col("o_orderstatus") == "F", "DRAFT")
        .otherwise("INACTIVE")
        .alias("status"),
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("referencenumber"),
        F.concat("o_orderpriority", F.lit(" <b>&")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("City "), (F.col("o_custkey") % 25).cast("string")).alias("city"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("salary"),
        F.concat(F.lit("https://e.com/job?id="), key.cast("string"), F.lit("&x=1")).alias("url"),
        F.lit("MINIJOB").alias("jobtype"),
        by_index(LANGUAGES, "o_orderkey % 3").alias("language"),
        F.concat(F.lit("Cat "), (key % 6).cast("string")).alias("category"),
        F.concat(F.lit("<p>Job "), key.cast("string"), F.lit(' für "alle"</p>')).alias("description"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "yyyy-MM-dd").alias("endDate"),
        key.alias("row_no"),
    )


def job_feed(spark, d):
    return plan.job_feed(feed_rows(spark, d), COMPANY)


def job_feed_xml(spark, d):
    """Publish the feed as XML and read the published jobs back, with the header of their document."""
    path = shared_dir(spark, "feed")
    feed = job_feed(spark, d)
    sinks.write_job_xml(feed, path, COMPANY, "https://e.com/?a=1&b=2", "2024-01-31T12:00:00.000Z", ["referencenumber", "url"])
    return sinks.read_published_xml(spark, path, feed.columns, header=True)


def job_view(spark, d):
    requests = read(spark, d, "events").select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("R"), (F.col("user_id") * 11).cast("string"))).alias("job_id"),
        F.when(F.col("event_id") % 4 == 2, (F.col("event_id") * 2).cast("string"))
        .otherwise(by_index(DAVS, "event_id % 4"))
        .alias("dav"),
    )
    return plan.job_view(feed_rows(spark, d), requests)


def posted_jobs(spark, d):
    """Jobs as the JSON texts in which they are posted."""
    rows = feed_rows(spark, d)
    posted = F.struct(*[F.col(new).alias(old) for old, new in job_source.POSTED_FIELDS.items()])
    return rows.select(F.to_json(posted).alias("body"))


def job_intake(spark, d):
    return job_source.job_events(posted_jobs(spark, d), "body")


def job_intake_files(spark, d):
    """Write posted jobs as JSON files and take them in."""
    path = shared_dir(spark, "posted")
    posted_jobs(spark, d).write.mode("overwrite").text(path)
    return job_source.read_job_events(spark, path)


def _parts(spark, d):
    """Parts spread over tasks however they are stored: each becomes a listing of many times its size."""
    return read(spark, d, "part").hint("rebalance")


def _listings(spark, d):
    """Parts as board listings in XML with nested locations."""
    path = shared_dir(spark, "listings")
    key = F.col("p_partkey").cast("string")
    location = F.array(F.struct(F.col("p_brand").alias("city")), F.struct(F.col("p_type").alias("city")))
    details = F.struct(
        F.concat("p_name", F.lit(" <x>&")).alias("jobtitle"),
        F.struct(location.alias("location")).alias("joblocations"),
        *[F.concat(F.lit(f"<div>{s} "), key, F.lit("</div>")).alias(s) for s in job_source.SECTIONS],
    )
    rows = _parts(spark, d).select(F.concat(F.lit("P"), key).alias("_reference_id"), details.alias("jobdetails"))
    rows.write.mode("overwrite").format("xml").option("rootTag", "joblistings").option("rowTag", "joblisting").save(path)
    return path


def job_description(language):
    def run(spark, d):
        listings = job_source.read_job_xml(spark, _listings(spark, d), "stepstone")
        return plan.job_description(listings, language)

    return run


def job_listing_flat(spark, d):
    path = shared_dir(spark, "flat")
    _parts(spark, d).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("region"),
        F.col("p_size").cast("string").alias("salary"),
        F.concat(F.lit("<p>"), "p_type", F.lit("</p>")).alias("description"),
    ).write.mode("overwrite").format("xml").option("rootTag", "jobs").option("rowTag", "job").save(path)
    return job_source.read_job_xml(spark, path, "jobsora")


def _programs(spark, d):
    number = F.col("s_suppkey").cast("string")
    place = F.struct(F.col("s_name").alias("city"), F.concat(F.lit("Jobs "), number).alias("jobs"))
    other = F.struct(F.lit("Köln").alias("city"), F.lit("Bar, Küche").alias("jobs"))
    bonuses = read(spark, d, "supplier").select(
        F.concat(F.lit("B"), F.col("s_nationkey").cast("string")).alias("bonus_id"),
        F.col("s_suppkey").alias("row_no"),
        F.lit("50 EUR").alias("bonus"),
        (F.col("s_suppkey") % 9).cast("string").alias("shifts"),
        F.lit("2024-01-01").alias("start_date"),
        F.lit("2024-02-01").alias("end_date"),
        F.col("s_name").alias("city"),
        F.lit("Job").alias("job"),
        F.concat(F.lit("Terms "), number).alias("terms"),
        F.to_json(F.array(place, other)).alias("job_en"),
    )
    requests = read(spark, d, "customer").select(
        F.col("c_custkey").alias("request_id"), F.concat(F.lit("B"), (F.col("c_custkey") % 30).cast("string")).alias("bonus_id")
    )
    return plan.bonus_program(bonuses, requests)


def bonus_program(spark, d):
    return _programs(spark, d).drop("places")


def bonus_places(spark, d):
    return plan.bonus_places(_programs(spark, d))


def review_decisions(spark, d):
    """Turns of a conversation as successive actions on one review, an hour apart."""
    edits = F.col("turn") % 2 == 0
    actions = read(spark, d, "conversations").select(
        F.col("conv_id").alias("review_id"),
        F.col("turn").alias("action_id"),
        F.when(edits, "edit").otherwise("approve").alias("action"),
        F.col("text").alias("response"),
        F.when(edits, F.concat(F.lit("It's '"), "text")).alias("edited_response"),
        F.col("role").alias("approver"),
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(conv_id * 37 + turn as int), 0, 0)"
        ).alias("ts"),
    )
    return reviews.review_decisions(actions)


QUERIES = {
    "job_feed": job_feed,
    "job_feed_xml": job_feed_xml,
    "job_view": job_view,
    "job_intake": job_intake,
    "job_intake_files": job_intake_files,
    "job_description": job_description("de"),
    "job_description_en": job_description("en"),
    "job_listing_flat": job_listing_flat,
    "bonus_program": bonus_program,
    "bonus_places": bonus_places,
    "review_decisions": review_decisions,
}

_FEED = with_tables(
    f"""SELECT referencenumber, title, date, city, salary, url, jobtype, language, category,
    description || '<div><br><em>{plan.NOTE_DE}</em></div>' AS description, 'Deutschland' AS country,
    '{COMPANY}' AS company, '{COMPANY}' AS sourcename FROM feed_rows WHERE status = 'LIVE'""",
    SQL,
)
_INTAKE = with_tables(
    """SELECT 'DRAFT' AS status, referencenumber, title, date, city, salary, url, jobtype, description,
    end_day AS "endDate", language FROM feed_rows""",
    SQL,
)
_SHOWN = ", ".join(f"CASE WHEN result = 'ok' THEN {c} END AS {c}" for c in plan.VIEW_FIELDS)


def _listing_sql(headings):
    parts = " || ".join(
        f"'{head}<div>{section} ' || p_partkey || '</div>'"
        for section, head in zip(job_source.SECTIONS, ["", *headings], strict=True)
    )
    return f"""SELECT 'P' || p_partkey AS referencenumber, p_name || ' <x>&' AS title, p_brand || ', ' || p_type AS city,
    {parts} AS description FROM part"""


_BONUS = {
    **SQL,
    "last_bonus": "SELECT * FROM bonus_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_no DESC) = 1",
    "bonus_requests": """SELECT c_custkey AS request_id, 'B' || (c_custkey % 30) AS bonus_id, l.*
    FROM customer LEFT JOIN last_bonus l ON l.id = 'B' || (c_custkey % 30)""",
}

ORACLE = {
    "job_feed": _FEED,
    "job_feed_xml": f"""SELECT *, '{COMPANY}' AS publisher, 'https://e.com/?a=1&b=2' AS publisherurl,
    '2024-01-31T12:00:00.000Z' AS lastbuilddate FROM ({_FEED})""",
    "job_view": with_tables(
        f"""
    SELECT request_id, result, {_SHOWN}, CASE WHEN result = 'ok' THEN description || '<div id=''hiddenPara''><br><em>' ||
           CASE WHEN language = 'en' THEN '{plan.NOTE_EN}' ELSE '{plan.NOTE_DE}' END || '</em></div>' END AS description
    FROM (SELECT r.request_id, CASE WHEN r.job_id IS NULL THEN 'generic' WHEN f.status IS NULL THEN 'jobNotFound'
                 WHEN f.status = 'LIVE' THEN 'ok' ELSE 'jobInactive' END AS result, f.*
          FROM view_requests r LEFT JOIN (SELECT *, max(row_no) OVER (PARTITION BY referencenumber) AS last_no FROM feed_rows) f
               ON r.job_id IS NOT NULL AND CASE WHEN r.request_id % 4 = 2 THEN CAST(f.row_no AS VARCHAR) = r.dav
                  ELSE f.referencenumber = r.job_id AND f.row_no = f.last_no END)""",
        SQL,
    ),
    "job_intake": _INTAKE,
    "job_intake_files": _INTAKE,
    "job_description": _listing_sql([de for de, _ in plan.HEADINGS.values()]),
    "job_description_en": _listing_sql([other for _, other in plan.HEADINGS.values()]),
    "job_listing_flat": """SELECT 'P' || p_partkey AS referencenumber, p_name AS title, p_brand AS city,
    CAST(p_size AS VARCHAR) AS salary, '<p>' || p_type || '</p>' AS description FROM part""",
    "bonus_program": with_tables(
        """SELECT request_id, bonus_id, CASE WHEN id IS NULL THEN 'bonusNotFound' ELSE 'ok' END AS result, bonus, shifts,
        CASE WHEN id IS NOT NULL THEN '2024-01-01' END AS start_date, CASE WHEN id IS NOT NULL THEN '2024-02-01' END AS end_date,
        city, CASE WHEN id IS NOT NULL THEN 'Job' END AS job, terms,
        city || ': Jobs ' || row_no || '; Köln: Bar, Küche' AS places_text FROM bonus_requests""",
        _BONUS,
    ),
    "bonus_places": with_tables(
        """SELECT request_id, bonus_id, 0 AS place_no, city, 'Jobs ' || row_no AS jobs FROM bonus_requests WHERE id IS NOT NULL
        UNION ALL SELECT request_id, bonus_id, 1, 'Köln', 'Bar, Küche' FROM bonus_requests WHERE id IS NOT NULL""",
        _BONUS,
    ),
    "review_decisions": """
    SELECT review_id, action, final_response, replace(final_response, '''', '''''') AS checked_response,
           'Response ' || CASE action WHEN 'edit' THEN 'submitted' ELSE 'approved' END || ' by ' || role || ' on ' ||
           strftime(timezone('Europe/Berlin', timezone('UTC', TIMESTAMP '2024-01-01' + to_hours(conv_id * 37 + turn))),
                    '%-d.%-m.%Y, %H:%M:%S') AS audit_line
    FROM (SELECT *, conv_id AS review_id, CASE WHEN turn % 2 = 0 THEN 'edit' ELSE 'approve' END AS action,
                 CASE WHEN turn % 2 = 0 THEN 'It''s ''' || text ELSE text END AS final_response
          FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)""",
}
