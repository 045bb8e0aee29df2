"""Daily report blocks, the stacked report, contacts placing orders, and the report readers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_analytics.functions import dates, text
from campaign_analytics.operators import aggregates, filters, sets, windows
from campaign_analytics.plans import reporting
from campaign_analytics.session import shared_dir
from campaign_analytics.sources import reports as readers
from campaign_analytics.sources import sinks

from .tables import SHIFT_AS_OF, day_text, key_count, read, report_tables, star_tables, with_tables

START, END = "1996-01-01", "1999-12-31"
EVENT_START, EVENT_END = "2024-01-03", "2024-01-27"
INCLUDE, EXCLUDE = ["brand#1", "brand#2"], ["brand#12", "BRAND#21"]
SITE_PAGES = ["/EN/", "view", "sign"]


def _days(df, *cols):
    return df.withColumns({c: day_text(c) for c in cols})


def event_counts(spark, d):
    return _days(aggregates.event_counts(reporting.report_events(report_tables(spark, d)["event_report"], "I")), "date_dt")


def organic_daily(spark, d):
    t = report_tables(spark, d)["organic_search"]
    return _days(aggregates.organic_daily(reporting.report_organic(t, EVENT_START, EVENT_END, SITE_PAGES)), "date_dt")


def paid_daily(spark, d):
    t = report_tables(spark, d)["channel_cost"]
    return _days(aggregates.paid_daily(reporting.report_costs(t, START, END, INCLUDE, EXCLUDE, "all")), "date_dt")


def pageviews_by_origin(spark, d):
    t = report_tables(spark, d)["page_report"]
    return _days(aggregates.pageviews_by_origin(reporting.report_pages(t, SITE_PAGES)), "date_dt")


def basis_report(spark, d):
    t = report_tables(spark, d)
    out = reporting.basis_report(
        t["event_report"], t["organic_search"], t["channel_cost"], t["page_report"],
        EVENT_START, EVENT_END, INCLUDE, EXCLUDE, SITE_PAGES, event_text="I",
    )
    return _days(out, "date_dt")


def basis_report_costs(spark, d):
    """The same report over the years of the cost table."""
    t = report_tables(spark, d)
    out = reporting.basis_report(
        t["event_report"], t["organic_search"], t["channel_cost"], t["page_report"],
        START, END, INCLUDE, EXCLUDE, SITE_PAGES, event_text="I", exclude_mode="all",
    )
    return _days(out, "date_dt")


def campaign_filter(mode):
    def run(spark, d):
        return filters.campaign_filter(report_tables(spark, d)["channel_cost"], INCLUDE, EXCLUDE, mode)

    return run


def in_list(spark, d):
    costs = report_tables(spark, d)["channel_cost"]
    kept = filters.in_list(costs, "campaign", filters.campaign_filter(costs, INCLUDE, EXCLUDE, "all"))
    return aggregates.sum_by(kept, ["campaign"], {"clicks": "clicks"})


def web_origin(spark, d):
    pages = report_tables(spark, d)["page_report"]
    return pages.select("sessionSourceMedium", filters.web_origin(F.col("sessionSourceMedium")).alias("origin")).groupBy(
        "sessionSourceMedium", "origin"
    ).agg(F.count("*").alias("pages"))


def contains_any(spark, d):
    texts = ["the", "ELLE", "dans"]
    return read(spark, d, "documents").select(
        "doc_id",
        text.contains_any(F.col("text"), texts).cast("int").alias("any_case"),
        text.contains_any(F.col("text"), texts, ignore_case=False).cast("int").alias("same_case"),
        text.contains_ci(F.col("source"), "WEB").cast("int").alias("from_web"),
    )


def contacts_placing_orders(spark, d):
    return _days(reporting.contacts_placing_orders(star_tables(spark, d), SHIFT_AS_OF), "order_created_dt")


def company_orders(spark, d):
    out = reporting.company_orders(star_tables(spark, d), *dates.rolling_range(SHIFT_AS_OF, 90, 1))
    return _days(out, "order_created_dt")


def group_count(spark, d):
    orders = reporting.company_orders(star_tables(spark, d), *dates.rolling_range(SHIFT_AS_OF, 90, 1))
    return aggregates.group_count(orders, [c for c in orders.columns if c not in reporting.ORDER_METRICS])


def grand_total(spark, d):
    return aggregates.grand_total(report_tables(spark, d)["channel_cost"], "ad_cost", "b2b_spend")


def date_batches(spark, d):
    bounds = read(spark, d, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("start_date"), F.max("l_shipdate").cast("date").alias("end_date")
    )
    return _days(readers.date_batches(bounds, 20), "start_date", "end_date", "first_day", "last_day")


def scan_between(spark, d):
    orders = read(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    rows = readers.scan_between(orders, "day", *dates.rolling_range(SHIFT_AS_OF, 90, 1))
    return rows.select("o_orderkey", "o_custkey", day_text("day").alias("day"))


def week_ends(spark, d):
    day = F.col("o_orderdate").cast("date")
    return read(spark, d, "orders").select(
        "o_orderkey",
        day_text(dates.last_full_week_end(day)).alias("week_end"),
        day_text(dates.rolling_range(day, 7, 1)[0]).alias("week_start"),
        day_text(dates.compact_date(F.date_format("o_orderdate", "yyyyMMdd"))).alias("day"),
    )


def flatten_metrics(spark, d):
    body = F.format_string(
        '{"%s": {"k": %s, "value": %s, "note": "n/a"}}',
        F.date_format("ts", "yyyy-MM-dd"), key_count().cast("string"), F.col("value").cast("string"),
    )
    fetched = read(spark, d, "events").select("event_id", body.alias("body"))
    return readers.flatten_metrics_by_date(fetched, "body", ["k", "value", "note"])


def flatten_metrics_long(spark, d):
    body = F.format_string(
        '{"%s": {"k": %s, "value": %s}}',
        F.date_format("ts", "yyyy-MM-dd"), key_count().cast("string"), F.col("value").cast("string"),
    )
    fetched = read(spark, d, "events").select("event_id", body.alias("body"))
    return readers.flatten_metrics_long(fetched, "body")


def flatten_report(spark, d):
    def header(*names):
        return F.array(*[F.struct(F.lit(n).alias("name")) for n in names])

    def values(*cols):
        return F.array(*[F.struct(F.col(c).cast("string").alias("value")) for c in cols])

    def row(*cols):
        return F.struct(values(*cols[:2]).alias("dimension_values"), values(*cols[2:]).alias("metric_values"))

    responses = read(spark, d, "orders").select(
        "o_orderkey",
        header("status", "priority").alias("dimension_headers"),
        header("customer").alias("metric_headers"),
        F.array(
            row("o_orderstatus", "o_orderpriority", "o_custkey"), row("o_orderpriority", "o_orderstatus", "o_orderkey")
        ).alias("rows"),
    )
    return readers.flatten_report(responses, ["priority", "status"], ["customer"])


def report_csv(spark, d):
    """Write an extract and read its first columns back."""
    path = shared_dir(spark, "extract")
    orders = read(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    sinks.write_extract(orders, path)
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in orders.schema]
    )
    return readers.read_report_csv(spark, path, schema, n_cols=4)


def report_pages(spark, d):
    """Write the event report as JSON pages and read them back typed."""
    path = shared_dir(spark, "pages")
    report_tables(spark, d)["event_report"].write.mode("overwrite").json(path)
    return _days(readers.read_report_pages(spark, path, ["date", "eventName"], ["eventCount"]), "date")


def report_table(spark, d):
    """Replace a named table twice, other columns first, and read it by its name."""
    report = basis_report(spark, d)
    sinks.replace_table(report.select("date_dt"), "stacked_report")
    sinks.replace_table(report, "stacked_report")
    return spark.table("stacked_report")


def paid_daily_micros(spark, d):
    """Costs in millionths of a unit and parts of them: no digit is lost on the way to the sums."""
    costs = report_tables(spark, d)["channel_cost"]
    micros = (F.col("ad_cost") * F.lit("1.000001").cast("decimal(7,6)") + F.lit("0.000000000001").cast("decimal(13,12)")).cast("decimal(28,12)")
    return _days(aggregates.paid_daily(costs.withColumn("ad_cost", micros)), "date_dt")


def top_spend_days(spark, d):
    days = aggregates.paid_daily(report_tables(spark, d)["channel_cost"])
    return _days(sets.head(days, 5, [F.col("b2b_spend").desc(), F.col("date_dt")]), "date_dt")


def top1_ties(spark, d):
    """Each customer's largest order, by priority class; ties stay."""
    orders = read(spark, d, "orders").select("o_custkey", "o_orderpriority", F.round("o_totalprice", -4).alias("total"))
    return windows.top1_ties(orders, ["o_custkey"], "total")


def top1_ties_nulls_first(spark, d):
    """Each customer's first order by total, unknown totals before known ones, then by day."""
    orders = read(spark, d, "orders").select(
        "o_custkey",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(F.col("o_orderkey") % 7 != 0, F.round("o_totalprice", -5)).alias("total"),
    )
    return windows.top1_ties(orders, ["o_custkey"], ["total", "month"], nulls_first=True)


def union_batches(spark, d):
    """Two pulls of one table put together again, with a set of the values seen."""
    costs = report_tables(spark, d)["channel_cost"]
    pulls = [readers.scan_between(costs, "date_dt", a, b) for a, b in [(START, "1997-12-31"), ("1998-01-01", END)]]
    return sets.distinct_values(sets.union_all(pulls), "campaign")


QUERIES = {
    "event_counts": event_counts,
    "organic_daily": organic_daily,
    "paid_daily": paid_daily,
    "paid_daily_micros": paid_daily_micros,
    "pageviews_by_origin": pageviews_by_origin,
    "basis_report": basis_report,
    "basis_report_costs": basis_report_costs,
    "campaign_filter": campaign_filter("all"),
    "campaign_filter_any": campaign_filter("any"),
    "in_list": in_list,
    "web_origin": web_origin,
    "contains_any": contains_any,
    "company_orders": company_orders,
    "contacts_placing_orders": contacts_placing_orders,
    "group_count": group_count,
    "grand_total": grand_total,
    "date_batches": date_batches,
    "scan_between": scan_between,
    "week_ends": week_ends,
    "flatten_metrics": flatten_metrics,
    "flatten_metrics_long": flatten_metrics_long,
    "flatten_report": flatten_report,
    "report_csv": report_csv,
    "report_pages": report_pages,
    "report_table": report_table,
    "top_spend_days": top_spend_days,
    "top1_ties": top1_ties,
    "top1_ties_nulls_first": top1_ties_nulls_first,
    "union_batches": union_batches,
}

_EVENTS = """
    SELECT CAST(strptime(date, '%Y%m%d') AS DATE) AS day, "eventName", sum("eventCount") AS "eventCount"
    FROM event_report WHERE "eventName" ILIKE '%i%' GROUP BY ALL"""
_ALL_OUT = "NOT (campaign ILIKE '%brand#12%' OR campaign ILIKE '%brand#21%')"
_ANY_OUT = "NOT (campaign ILIKE '%brand#12%' AND campaign ILIKE '%brand#21%')"
_WANTED = "(campaign ILIKE '%brand#1%' OR campaign ILIKE '%brand#2%')"


def _organic(start, end):
    return f"""
    SELECT date AS day, sum(impressions) AS impressions, sum(clicks) AS clicks FROM organic_search
    WHERE date BETWEEN DATE '{start}' AND DATE '{end}' AND regexp_matches(page, '/EN/|view|sign') GROUP BY ALL"""


def _paid(start, end, out):
    return f"""
    SELECT date_dt AS day, CAST(sum(ad_cost) AS DOUBLE) AS spend, sum(impressions) AS impressions, sum(clicks) AS clicks
    FROM channel_cost WHERE date_dt BETWEEN DATE '{start}' AND DATE '{end}' AND {_WANTED} AND {out} GROUP BY ALL"""


_PAGES = """
    SELECT CAST(strptime(date, '%Y%m%d') AS DATE) AS day,
           CASE WHEN "sessionSourceMedium" LIKE '(direct) / %' OR "sessionSourceMedium" LIKE '% / organic'
                THEN 'Organic' ELSE 'Paid' END AS origin, sum("screenPageViews") AS views
    FROM page_report WHERE regexp_matches("pagePath", '(?i)/en/|view|sign') GROUP BY ALL"""


def _stacked(start, end, out):
    return with_tables(
        """
    SELECT CAST(day AS VARCHAR) AS date_dt, "eventName", NULL AS web_origin_type, "eventCount",
           NULL AS b2b_organic_impressions, NULL AS b2b_organic_clicks, NULL AS b2b_spend, NULL AS b2b_paid_impr,
           NULL AS b2b_paid_clicks, NULL AS ga4_pageviews FROM events_block
    UNION ALL SELECT CAST(day AS VARCHAR), NULL, NULL, NULL, impressions, clicks, NULL, NULL, NULL, NULL FROM organic_block
    UNION ALL SELECT CAST(day AS VARCHAR), NULL, NULL, NULL, NULL, NULL, spend, impressions, clicks, NULL FROM paid_block
    UNION ALL SELECT CAST(day AS VARCHAR), NULL, origin, NULL, NULL, NULL, NULL, NULL, NULL, views FROM pages_block""",
        {"events_block": _EVENTS, "organic_block": _organic(start, end), "paid_block": _paid(start, end, out), "pages_block": _PAGES},
    )


_STAR = {
    "star_rows": f"""
    SELECT u.id AS company_user_id, u.first_name, u.last_name, u.email, k.name AS company_name,
           i.industry_category_summarized_name, b.business_region_name,
           CAST(o.created_dt AS VARCHAR) AS order_created_dt, o.id AS company_order_id, s.company_order_shift_id
    FROM company_user u, company_order o, company k, industry_subcategory i, company_order_shift s, job_category c,
         job_location l, business_region b
    WHERE o.created_by_id = u.id AND k.company_id = u.company_id
      AND i.industry_subcategory_id = k.industry_subcategory_id AND s.company_order_id = o.id
      AND c.job_category_id = s.job_category_id AND l.job_location_id = s.job_location_id
      AND b.business_region_id = l.business_region_id
      AND o.created_dt BETWEEN DATE '{SHIFT_AS_OF}' - 90 AND DATE '{SHIFT_AS_OF}' - 1"""
}
_STAR_DIMS = (
    "company_user_id, first_name, last_name, email, company_name, industry_category_summarized_name, "
    "business_region_name, order_created_dt"
)

ORACLE = {
    "event_counts": with_tables(
        'SELECT CAST(day AS VARCHAR) AS date_dt, "eventName", "eventCount" FROM b', {"b": _EVENTS}
    ),
    "organic_daily": with_tables(
        """SELECT CAST(day AS VARCHAR) AS date_dt, impressions AS b2b_organic_impressions,
        clicks AS b2b_organic_clicks FROM b""",
        {"b": _organic(EVENT_START, EVENT_END)},
    ),
    "paid_daily": with_tables(
        """SELECT CAST(day AS VARCHAR) AS date_dt, spend AS b2b_spend, impressions AS b2b_paid_impr,
        clicks AS b2b_paid_clicks FROM b""",
        {"b": _paid(START, END, _ALL_OUT)},
    ),
    "paid_daily_micros": with_tables(
        """SELECT CAST(date_dt AS VARCHAR) AS date_dt,
        CAST(sum(CAST(ad_cost * CAST(1.000001 AS DECIMAL(7,6)) + CAST(0.000000000001 AS DECIMAL(13,12)) AS DECIMAL(28,12))) AS DOUBLE)
            AS b2b_spend,
        sum(impressions) AS b2b_paid_impr, sum(clicks) AS b2b_paid_clicks FROM channel_cost GROUP BY date_dt"""
    ),
    "pageviews_by_origin": with_tables(
        "SELECT CAST(day AS VARCHAR) AS date_dt, origin AS web_origin_type, views AS ga4_pageviews FROM b", {"b": _PAGES}
    ),
    "basis_report": _stacked(EVENT_START, EVENT_END, _ANY_OUT),
    "basis_report_costs": _stacked(START, END, _ALL_OUT),
    "campaign_filter": with_tables(f"SELECT DISTINCT campaign FROM channel_cost WHERE {_WANTED} AND {_ALL_OUT}"),
    "campaign_filter_any": with_tables(f"SELECT DISTINCT campaign FROM channel_cost WHERE {_WANTED} AND {_ANY_OUT}"),
    "in_list": with_tables(
        f"SELECT campaign, sum(clicks) AS clicks FROM channel_cost WHERE {_WANTED} AND {_ALL_OUT} GROUP BY campaign"
    ),
    "web_origin": with_tables(
        """SELECT "sessionSourceMedium", CASE "sessionSourceMedium" WHEN 'search / organic' THEN 'Organic'
        WHEN '(direct) / (none)' THEN 'Organic' ELSE 'Paid' END AS origin, count(*) AS pages
        FROM page_report GROUP BY ALL"""
    ),
    "contains_any": """SELECT doc_id, CAST(contains(upper(text), 'THE') OR contains(upper(text), 'ELLE')
        OR contains(upper(text), 'DANS') AS INTEGER) AS any_case,
        CAST(contains(text, 'the') OR contains(text, 'ELLE') OR contains(text, 'dans') AS INTEGER) AS same_case,
        CAST(source ILIKE '%web%' AS INTEGER) AS from_web FROM documents""",
    "company_orders": with_tables("SELECT * FROM star_rows", _STAR),
    "contacts_placing_orders": with_tables(
        f"""SELECT {_STAR_DIMS}, count(DISTINCT company_order_id) AS unique_company_orders,
        count(DISTINCT company_order_shift_id) AS unique_company_order_shifts FROM star_rows GROUP BY ALL""",
        _STAR,
    ),
    "group_count": with_tables(f"SELECT count(*) AS groups FROM (SELECT DISTINCT {_STAR_DIMS} FROM star_rows)", _STAR),
    "grand_total": with_tables("SELECT CAST(sum(ad_cost) AS DOUBLE) AS b2b_spend FROM channel_cost"),
    "date_batches": """
    SELECT CAST(a AS VARCHAR) AS start_date, CAST(b AS VARCHAR) AS end_date, CAST(n AS INTEGER) AS batch,
           CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day
    FROM (SELECT a, b, CAST(day AS DATE) AS day, date_diff('day', a, CAST(day AS DATE)) // 20 AS n
          FROM (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem),
               LATERAL (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day))
    GROUP BY a, b, n""",
    "scan_between": f"""SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{SHIFT_AS_OF}' - 90 AND DATE '{SHIFT_AS_OF}' - 1""",
    "week_ends": """SELECT o_orderkey, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) - 1 AS VARCHAR) AS week_end,
    CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS week_start, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders""",
    "flatten_metrics": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value, CAST(NULL AS DOUBLE) AS note FROM events""",
    "flatten_metrics_long": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, 'k' AS metric,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events
    UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%d'), 'value', value FROM events""",
    "flatten_report": """SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status,
    CAST(o_custkey AS VARCHAR) AS customer FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderkey AS VARCHAR) FROM orders""",
    "report_csv": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "report_pages": with_tables(
        """SELECT CAST(CAST(strptime(date, '%Y%m%d') AS DATE) AS VARCHAR) AS date, "eventName", "eventCount"
        FROM event_report"""
    ),
    "report_table": _stacked(EVENT_START, EVENT_END, _ANY_OUT),
    "top_spend_days": with_tables(
        """SELECT CAST(date_dt AS VARCHAR) AS date_dt, CAST(sum(ad_cost) AS DOUBLE) AS b2b_spend,
        sum(impressions) AS b2b_paid_impr, sum(clicks) AS b2b_paid_clicks FROM channel_cost GROUP BY date_dt
        ORDER BY sum(ad_cost) DESC, date_dt LIMIT 5"""
    ),
    "top1_ties_nulls_first": """SELECT o_custkey, month, total FROM (
        SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY total DESC NULLS FIRST, month DESC NULLS FIRST) AS place
        FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month,
                     CASE WHEN o_orderkey % 7 <> 0 THEN round(o_totalprice, -5) END AS total FROM orders)) WHERE place = 1""",
    "top1_ties": """SELECT o_custkey, o_orderpriority, total FROM (
    SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY total DESC) AS place
    FROM (SELECT o_custkey, o_orderpriority, round(o_totalprice, -4) AS total FROM orders)) WHERE place = 1""",
    "union_batches": with_tables(
        f"SELECT DISTINCT campaign FROM channel_cost WHERE date_dt BETWEEN DATE '{START}' AND DATE '{END}'"
    ),
}
