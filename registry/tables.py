"""The library's input tables as views over the driver's tables, in Spark and in SQL.

``SQL`` holds one select per logical table; ``with_tables`` puts the ones a query mentions in front
of it. The Spark functions below build the same tables from parquet.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
SHIFT_AS_OF = "1998-06-01"


# Schemas of the driver's tables, so that reading one starts no job to find its schema out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def key_count(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def day_text(col: str | Column) -> Column:
    """Dates leave the queries as text, which every engine writes alike."""
    return (F.col(col) if isinstance(col, str) else col).cast("date").cast("string")


def ts_text(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


SQL: dict[str, str] = {}

# --- recommendation ---------------------------------------------------------------------------

SQL["talent_eligibility"] = f"""
    SELECT unnest([DATE '{AS_OF}', DATE '{AS_OF}' - 1]) AS date_dt,
           c_custkey AS eligible_matched_talent, 'T' || (c_custkey % 3) AS matched_tag
    FROM customer"""
SQL["dim_talent"] = """
    SELECT c_custkey AS talent_id, 'u' || c_custkey AS user_uuid, n_name AS employment_city,
           r_name AS matching_region_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
SQL["fact_job"] = """
    SELECT o_orderkey AS job_id, 'j' || o_orderkey AS job_uuid, o_orderkey % 25 AS job_category_fk,
           'T' || (o_orderkey % 3) AS mandatory_include_tags
    FROM orders"""
SQL["dim_job_category"] = "SELECT n_nationkey AS job_category_id, n_name AS job_category_name FROM nation"
SQL["fact_shift"] = """
    SELECT o_custkey AS booked_shift_talent_id, l_orderkey AS job_fk, l_partkey % 25 AS job_category_fk,
           CAST(l_shipdate AS DATE) AS shift_dt, n_name AS business_region,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS ordered_revenue_value,
           CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
               AS booked_revenue_value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey"""
SQL["dim_business_region"] = """
    SELECT n_name AS business_region_name, r_name AS matching_region_name
    FROM nation JOIN region ON n_regionkey = r_regionkey"""
SQL["job_apply_core"] = """
    SELECT 'u' || user_id AS talent_uuid, 'j' || event_id AS job_uuid, ts AS "timestamp"
    FROM events WHERE event_type = 'click'"""
SQL["job_details_seen"] = """
    SELECT 'u' || user_id AS talent_uuid, 'j' || event_id AS job_uuid, ts AS last_job_details_seen,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS job_details_seen_count
    FROM events WHERE event_type = 'view'"""


def recommend_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    def tagged(key: str) -> Column:
        return F.concat(F.lit("T"), (F.col(key) % 3).cast("string"))

    def named(prefix: str, key: str) -> Column:
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    places = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    day = F.lit(AS_OF).cast("date")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    events = read(spark, d, "events").withColumn("talent_uuid", named("u", "user_id")).withColumn(
        "job_uuid", named("j", "event_id")
    )
    return {
        "talent_eligibility": read(spark, d, "customer").select(
            F.explode(F.array(day, F.date_sub(day, 1))).alias("date_dt"),
            F.col("c_custkey").alias("eligible_matched_talent"),
            tagged("c_custkey").alias("matched_tag"),
        ),
        "dim_talent": read(spark, d, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("talent_id"),
            named("u", "c_custkey").alias("user_uuid"),
            F.col("n_name").alias("employment_city"),
            F.col("r_name").alias("matching_region_name"),
        ),
        "fact_job": read(spark, d, "orders").select(
            F.col("o_orderkey").alias("job_id"),
            named("j", "o_orderkey").alias("job_uuid"),
            (F.col("o_orderkey") % 25).alias("job_category_fk"),
            tagged("o_orderkey").alias("mandatory_include_tags"),
        ),
        "dim_job_category": read(spark, d, "nation").select(
            F.col("n_nationkey").alias("job_category_id"), F.col("n_name").alias("job_category_name")
        ),
        "fact_shift": read(spark, d, "lineitem")
        .join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_custkey").alias("booked_shift_talent_id"),
            F.col("l_orderkey").alias("job_fk"),
            (F.col("l_partkey") % 25).alias("job_category_fk"),
            F.col("l_shipdate").cast("date").alias("shift_dt"),
            F.col("n_name").alias("business_region"),
            price.alias("ordered_revenue_value"),
            (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("booked_revenue_value"),
        ),
        "dim_business_region": places.select(
            F.col("n_name").alias("business_region_name"), F.col("r_name").alias("matching_region_name")
        ),
        "job_apply_core": events.where("event_type = 'click'").select(
            "talent_uuid", "job_uuid", F.col("ts").alias("timestamp")
        ),
        "job_details_seen": events.where("event_type = 'view'").select(
            "talent_uuid",
            "job_uuid",
            F.col("ts").alias("last_job_details_seen"),
            key_count().alias("job_details_seen_count"),
        ),
    }


# --- reports ----------------------------------------------------------------------------------

SQL["event_report"] = """
    SELECT strftime(ts, '%Y%m%d') AS date, event_type AS "eventName",
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "eventCount"
    FROM events"""
SQL["page_report"] = """
    SELECT strftime(DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER), '%Y%m%d') AS date,
           CASE WHEN url LIKE '%utm_source=feed%' THEN 'feed / cpc' WHEN url LIKE '%ref=x%' THEN '(direct) / (none)'
                WHEN url LIKE '%#top' THEN '(not set)' ELSE 'search / organic' END AS "sessionSourceMedium",
           url AS "pagePath", CAST(length(html) AS DOUBLE) AS "screenPageViews"
    FROM pages"""
SQL["channel_cost"] = """
    SELECT CAST(l_shipdate AS DATE) AS date_dt, p_brand AS campaign,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(20,4)) AS ad_cost,
           l_quantity AS impressions, CAST(l_linenumber AS DOUBLE) AS clicks
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
SQL["organic_search"] = """
    SELECT CAST(ts AS DATE) AS date, '/' || event_type AS page,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS impressions, CAST(event_id % 7 AS DOUBLE) AS clicks
    FROM events"""
SQL["company_user"] = """
    SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
           lower(c_name) || '@example.com' AS email, c_nationkey AS company_id FROM customer"""
SQL["company_order"] = "SELECT o_orderkey AS id, o_custkey AS created_by_id, CAST(o_orderdate AS DATE) AS created_dt FROM orders"
SQL["company"] = "SELECT n_nationkey AS company_id, n_name AS name, n_regionkey AS industry_subcategory_id FROM nation"
SQL["industry_subcategory"] = """
    SELECT r_regionkey AS industry_subcategory_id, r_name AS industry_category_summarized_name FROM region"""
SQL["company_order_shift"] = """
    SELECT l_orderkey * 10 + l_linenumber AS company_order_shift_id, l_orderkey AS company_order_id,
           l_partkey AS job_category_id, l_suppkey AS job_location_id FROM lineitem"""
SQL["job_category"] = "SELECT p_partkey AS job_category_id FROM part"
SQL["job_location"] = """
    SELECT s_suppkey AS job_location_id, n_regionkey AS business_region_id
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
SQL["business_region"] = "SELECT r_regionkey AS business_region_id, r_name AS business_region_name FROM region"


def report_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    events, lineitem = read(spark, d, "events"), read(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    url = F.col("url")
    return {
        "event_report": events.select(
            F.date_format("ts", "yyyyMMdd").alias("date"),
            F.col("event_type").alias("eventName"),
            key_count().cast("double").alias("eventCount"),
        ),
        "page_report": read(spark, d, "pages").select(
            F.date_format(
                F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int")), "yyyyMMdd"
            ).alias("date"),
            F.when(url.contains("utm_source=feed"), "feed / cpc")
            .when(url.contains("ref=x"), "(direct) / (none)")
            .when(url.endswith("#top"), "(not set)")
            .otherwise("search / organic")
            .alias("sessionSourceMedium"),
            url.alias("pagePath"),
            F.length("html").cast("double").alias("screenPageViews"),
        ),
        "channel_cost": lineitem.join(read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_shipdate").cast("date").alias("date_dt"),
            F.col("p_brand").alias("campaign"),
            (price * F.col("l_discount").cast("decimal(4,2)")).alias("ad_cost"),
            F.col("l_quantity").alias("impressions"),
            F.col("l_linenumber").cast("double").alias("clicks"),
            F.try_divide(F.col("l_extendedprice"), F.col("l_linenumber")).alias("cpc"),
        ),
        "organic_search": events.select(
            F.col("ts").cast("date").alias("date"),
            F.concat(F.lit("/"), F.col("event_type")).alias("page"),
            key_count().cast("double").alias("impressions"),
            (F.col("event_id") % 7).cast("double").alias("clicks"),
        ),
    }


def star_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    name = F.split("c_name", "#")
    return {
        "company_user": read(spark, d, "customer").select(
            F.col("c_custkey").alias("id"),
            F.get(name, F.lit(0)).alias("first_name"),
            F.get(name, F.lit(1)).alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("c_nationkey").alias("company_id"),
        ),
        "company_order": read(spark, d, "orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("created_by_id"),
            F.col("o_orderdate").cast("date").alias("created_dt"),
        ),
        "company": nation.select(
            F.col("n_nationkey").alias("company_id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("industry_subcategory_id"),
        ),
        "industry_subcategory": region.select(
            F.col("r_regionkey").alias("industry_subcategory_id"),
            F.col("r_name").alias("industry_category_summarized_name"),
        ),
        "company_order_shift": read(spark, d, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("company_order_shift_id"),
            F.col("l_orderkey").alias("company_order_id"),
            F.col("l_partkey").alias("job_category_id"),
            F.col("l_suppkey").alias("job_location_id"),
        ),
        "job_category": read(spark, d, "part").select(F.col("p_partkey").alias("job_category_id")),
        "job_location": read(spark, d, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("job_location_id"), F.col("n_regionkey").alias("business_region_id")),
        "business_region": read(spark, d, "region").select(
            F.col("r_regionkey").alias("business_region_id"), F.col("r_name").alias("business_region_name")
        ),
    }


# --- touches ----------------------------------------------------------------------------------

# Rule inputs by slot (event_id % 24), page URLs (% 13), referrers (% 7) and user agents (% 5).
SLOT_SOURCE = ["awin", "braze", "meta", "facebook", "meta", "meta", "linkedin", "linkedin", None, "google-search",
               None, "google-search", "instagram", "jobsora", None, None, "stepstone", "tiktok", "tiktok",
               "test_radio", "newsletter", "", "AWIN", None]
SLOT_CAMPAIGN = ["x", "x", "spring", "meta_spring", "meta_spring", "metaspring", "linkedin_q1", "q1", None, "pmax_de",
                 None, "brand", "x", "x", None, None, "x", "x", "tiktok_x", "x", "x", None, "x", None]
SLOT_REFERRER = [None, None, None, None, None, None, None, None, "linkedin", None, "google", None, None, None, "bing",
                 None, None, None, None, None, None, "google", None, "ownsite"]
URLS = [
    "https://e.com/?gclid=1",
    "https://e.com/jobs?utm_source=google&utm_medium=sem&utm_campaign=a+b",
    "https://e.com/?utm_source=meta&utm_medium=pfm&utm_campaign=meta_q1&utm_content=ad%201",
    "https://e.com/?utm_medium=cpm&fbclid=abc",
    "https://e.com/?utm_source=stepstone&utm_medium=cpad&utm_term=t1",
    "https://e.com/?utm_medium=cpc&utm_source=jobsora",
    "https://e.com/x/y?utm_source=tiktok&utm_medium=organic#frag",
    "https://e.com/",
    "https://e.com?first_ref=partner&awc=55_1",
    "https://e.com/?utm_source&utm_campaign=c%26d%3De",
    "https://e.com/?gbraid=G-1&utm_source=awin&awc=77",
    "https://e.com/?GCLID=2&utm_source=Instagram&utm_medium=organic",
    "https://e.com/?utm_campaign=a%2Bb&utm_campaign=second&utm_content=",
]
REFERRERS = [None, "https://www.google.com/", "https://www.google.com/search?q=x", "https://www.bing.com/",
             "android-app://com.google", "localhost/", "https://www.youtube.com/"]
AGENTS = ["Mozilla/5.0 (Linux; ANDROID 14)", "Mozilla/5.0 (iPhone; CPU)", "Mozilla/5.0 (iPad)", "Mozilla/5.0 (X11)", None]
DEVICES = ["android", "ios", "ios", "desktop", "desktop"]


def by_index(values: list, index: str) -> Column:
    """Text at a position of a fixed list, null past its end; one SQL expression for the whole list."""
    texts = ", ".join("NULL" if v is None else "'" + v.replace("'", "\\'") + "'" for v in values)
    return F.expr(f"get(CAST(array({texts}) AS array<string>), CAST({index} AS int))")


def sql_index(values: list, index: str) -> str:
    texts = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract(CAST([{texts}] AS VARCHAR[]), CAST({index} AS INTEGER) + 1)"


SQL["touches"] = f"""
    SELECT event_id, 'u' || user_id AS user_id, ts, {sql_index(SLOT_SOURCE, "event_id % 24")} AS utm_source,
           {sql_index(SLOT_CAMPAIGN, "event_id % 24")} AS utm_campaign,
           {sql_index(SLOT_REFERRER, "event_id % 24")} AS first_referrer, {sql_index(URLS, "event_id % 13")} AS url,
           {sql_index(REFERRERS, "event_id % 7")} AS referrer, {sql_index(AGENTS, "event_id % 5")} AS user_agent
    FROM events"""


def touches_from(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        "ts",
        by_index(SLOT_SOURCE, "event_id % 24").alias("utm_source"),
        by_index(SLOT_CAMPAIGN, "event_id % 24").alias("utm_campaign"),
        by_index(SLOT_REFERRER, "event_id % 24").alias("first_referrer"),
        by_index(URLS, "event_id % 13").alias("url"),
        by_index(REFERRERS, "event_id % 7").alias("referrer"),
        by_index(AGENTS, "event_id % 5").alias("user_agent"),
    )


def touches(spark: SparkSession, d: str) -> DataFrame:
    return touches_from(read(spark, d, "events"))


# --- assembling the SQL -----------------------------------------------------------------------


def with_tables(query: str, extra: dict[str, str] | None = None) -> str:
    """The query behind a WITH clause holding every logical table it mentions."""
    known = {**SQL, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in known.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.append(name)
                visit(body)

    visit(query)
    # A table is defined before its users: order by mention, deepest first.
    ordered: list[str] = []

    def place(name: str) -> None:
        for other in needed:
            if other != name and other not in ordered and re.search(rf"\b{other}\b", known[name]):
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        place(name)
    if not ordered:
        return query.strip()
    ctes = ",\n".join(f"{name} AS ({known[name]})" for name in ordered)
    return f"WITH {ctes}\n{query.strip()}"
