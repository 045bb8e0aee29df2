"""Deep links, tagged URLs, app links and the link log, over requests derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_analytics.functions import urls
from campaign_analytics.operators import sets
from campaign_analytics.operators.joins import default_campaign, map_lookup, tracker_lookup
from campaign_analytics.plans import links as plan
from campaign_analytics.plans.attribution import tracker_link
from campaign_analytics.session import shared_dir
from campaign_analytics.sources import sinks

from .attribution import SOURCES
from .attribution import SQL_SOURCE_LEGACY as SOURCE
from .tables import DEVICES, by_index, key_count, read, sql_index, touches, with_tables

PLATFORMS = ["Braze", "Google Ads", None]
CHANNELS = ["Push", "Email", "Canvas", "Website"]
TRACKED = ["Braze - Push", "Braze - Email", "Google Ads - Website", "Google Ads - Email", "Other - Push"]
LINK_NAMES = ["Job Feed (Homepage)", "Short term job offers with category", "LMS links", "Profile", "Empty"]
SCHEMES = ["/offers", "/offers/category=", "/lms/", "/profile", "/empty"]
EXAMPLES = ["app://offers", "app://offers/a b+c~(x)!ä?category=", "app://lms/", "app://profile", "app://e*'"]
CHOSEN = LINK_NAMES[:4] + ["", None]
DETAILS = ["Aufbauhelfer/in", "german_course", None]
DEFAULTS = ["Braze - Push", "Braze - Email", "Braze - Canvas", None, None]
CAMPAIGNS = ["spring & co", None, "a b"]
K = "CAST(get_json_object(props, '$.k') AS bigint)"
CONTENT = ["a b&c~(x)!ä", "", None, "it's*/+"]

SQL = {
    "link_requests": f"""
    SELECT event_id AS seq, {sql_index(PLATFORMS, "event_id % 3")} AS platform,
           {sql_index(CHANNELS, "event_id % 4")} AS channel, {sql_index(CHOSEN, "k % 6")} AS deeplink,
           {sql_index(DETAILS, "k % 3")} AS additional_detail, {sql_index(CAMPAIGNS, "event_id % 3")} AS campaign,
           CAST(NULL AS VARCHAR) AS adgroup, {sql_index(CONTENT, "k % 4")} AS creative,
           'https://e.com/?a=' || k AS fallback_url
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "tracker_ids": f"""
    SELECT platform_channel, arg_max(n_nationkey, n_nationkey) AS n
    FROM (SELECT n_nationkey, {sql_index(TRACKED, "n_nationkey % 5")} AS platform_channel FROM nation)
    GROUP BY platform_channel""",
    "link_types": f"""
    SELECT {sql_index(LINK_NAMES, "r_regionkey")} AS name, {sql_index(SCHEMES, "r_regionkey")} AS scheme,
           {sql_index(EXAMPLES, "r_regionkey")} AS example FROM region""",
    "default_values": f"""
    SELECT * FROM (SELECT {sql_index(DEFAULTS, "r_regionkey")} AS platform_channel, 'camp-' || r_name AS campaign,
           'group-' || r_name AS adgroup FROM region) WHERE platform_channel IS NOT NULL""",
    "tracked_requests": """
    SELECT q.*, 'and' || t.n AS android_id, 'ios' || t.n AS ios_id,
           coalesce(q.campaign, d.campaign, '') AS full_campaign, coalesce(q.adgroup, d.adgroup, '') AS full_adgroup,
           coalesce(q.creative, CASE WHEN d.campaign IS NOT NULL THEN 'c' END, '') AS full_creative
    FROM link_requests q LEFT JOIN tracker_ids t ON t.platform_channel = q.platform || ' - ' || q.channel
         LEFT JOIN default_values d ON d.platform_channel = q.platform || ' - ' || q.channel""",
}


_LAST = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY line DESC) = 1"
REPEATED = {
    **SQL,
    "repeated": f"""
    SELECT {sql_index(TRACKED, "s_suppkey % 5")} AS pc, s_name AS campaign, 'a' || s_nationkey AS adgroup,
           'and' || s_suppkey AS android, 'ios' || s_nationkey AS ios, {sql_index(LINK_NAMES, "s_suppkey % 5")} AS name,
           '/' || s_name AS scheme, s_suppkey * 7919 % 100003 AS line FROM supplier""",
    "last_by_platform": f"SELECT * FROM repeated {_LAST.format('pc')}",
    "last_by_name": f"SELECT * FROM repeated {_LAST.format('name')}",
    "last_by_source": f"""
    SELECT android || '_' || ios AS ids, {sql_index(SOURCES, "line % 7")} AS place FROM repeated
    {_LAST.format("place")}""",
}


def _encode(text):
    out = f"url_encode({text})"
    for code, char in [("%21", "!"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*")]:
        out = f"replace({out}, '{code}', '{char}')"
    return out


def requests(spark, d):
    k = key_count()
    return read(spark, d, "events").select(
        F.col("event_id").alias("seq"),
        by_index(PLATFORMS, "event_id % 3").alias("platform"),
        by_index(CHANNELS, "event_id % 4").alias("channel"),
        by_index(CHOSEN, K + " % 6").alias("deeplink"),
        by_index(DETAILS, K + " % 3").alias("additional_detail"),
        by_index(CAMPAIGNS, "event_id % 3").alias("campaign"),
        F.lit(None).cast("string").alias("adgroup"),
        by_index(CONTENT, K + " % 4").alias("creative"),
        F.concat(F.lit("https://e.com/?a="), k.cast("string")).alias("fallback_url"),
    )


def _trackers(spark, d):
    number = F.col("n_nationkey").cast("string")
    return read(spark, d, "nation").select(
        by_index(TRACKED, "n_nationkey % 5").alias("platform_channel"),
        F.concat(F.lit("and"), number).alias("android"),
        F.concat(F.lit("ios"), number).alias("ios"),
        F.col("n_nationkey").alias("seq"),
    )


def _link_types(spark, d):
    return read(spark, d, "region").select(
        by_index(LINK_NAMES, "r_regionkey").alias("name"),
        by_index(SCHEMES, "r_regionkey").alias("urlScheme"),
        by_index(EXAMPLES, "r_regionkey").alias("deeplinkExample"),
    )


def _defaults(spark, d):
    return read(spark, d, "region").select(
        by_index(DEFAULTS, "r_regionkey").alias("platform_channel"),
        F.concat(F.lit("camp-"), "r_name").alias("campaign"),
        F.concat(F.lit("group-"), "r_name").alias("adgroup"),
        F.lit("c").alias("creative"),
    )


def _deep_links(spark, d):
    tables = [requests(spark, d), _trackers(spark, d), _link_types(spark, d), _defaults(spark, d)]
    return plan.deep_links(*tables, order={"trackers": "seq"})


def deep_links(spark, d):
    return _deep_links(spark, d).select("seq", "error", "link")


def tracker_ids(spark, d):
    return tracker_lookup(requests(spark, d), _trackers(spark, d), order="seq").select(
        "seq", "platform", "channel", "android_id", "ios_id"
    )


def default_values(spark, d):
    return default_campaign(requests(spark, d), _defaults(spark, d)).select("seq", "campaign", "adgroup", "creative")


def utm_url(spark, d):
    t = touches(spark, d)
    content, term = by_index(CONTENT, "event_id % 4"), by_index(CAMPAIGNS, "event_id % 3")
    out = plan.utm_url(t.url, t.utm_campaign, F.lit("qr"), t.utm_source, content, term)
    return t.select("event_id", out.alias("link"))


def uri_component(spark, d):
    text = F.col("text")
    return read(spark, d, "benchmark").select(
        "item_id", urls.uri_component(text).alias("encoded"), urls.form_component(text).alias("form_encoded")
    )


def _link_log(spark, d):
    """The generated links, appended to the log in two goes and read back."""
    path = shared_dir(spark, "links")
    made = _deep_links(spark, d).where("error IS NULL")
    sinks.append_link_log(made.where("platform = 'Braze'"), path)
    sinks.append_link_log(made.where("platform <> 'Braze'"), path)
    return sinks.read_link_log(spark, path)


def link_page(page):
    """A page by its number; 0 is the last one and -1 one past it. At most 500 rows are sorted for it."""

    def run(spark, d):
        log = _link_log(spark, d)
        return sets.page_of(log, "seq", page if page > 0 else -(-log.count() // 10) - page, rows=500)

    return run


def lookup_duplicates(spark, d):
    """Lookup tables that repeat every name many times, in another order than their values': the last row counts."""
    table = read(spark, d, "supplier").select(
        by_index(TRACKED, "s_suppkey % 5").alias("platform_channel"),
        F.col("s_name").alias("campaign"),
        F.concat(F.lit("a"), F.col("s_nationkey").cast("string")).alias("adgroup"),
        F.lit("c").alias("creative"),
        F.concat(F.lit("and"), F.col("s_suppkey").cast("string")).alias("android"),
        F.concat(F.lit("ios"), F.col("s_nationkey").cast("string")).alias("ios"),
        by_index(LINK_NAMES, "s_suppkey % 5").alias("name"),
        F.concat(F.lit("/"), "s_name").alias("urlScheme"),
        F.lit("app://x").alias("deeplinkExample"),
        F.expr("s_suppkey * 7919L % 100003").alias("line"),
    )
    orders = {"trackers": "line", "links": "line", "defaults": "line"}
    made = plan.deep_links(requests(spark, d), table, table, table, order=orders)
    worded = map_lookup(made, "deeplink", table, "name", "adgroup", "category", F.lit("none"), order="line")
    places = table.withColumn("source", by_index(SOURCES, "line % 7"))
    tracked = tracker_link(touches(spark, d), places, "https://l.example/", order="line").select(
        F.col("event_id").alias("seq"), F.regexp_extract("tracker_url", r"^https://l\.example/([^?]*)", 1).alias("tracker_ids")
    )
    columns = ["seq", "android_id", "ios_id", "campaign", "adgroup", "urlScheme", "category"]
    return worded.select(*columns).join(tracked, "seq")


def app_link(spark, d):
    return plan.app_links(touches(spark, d), "https://links.example.com/store", "_spring").select("event_id", "device", "app_link")


QUERIES = {
    "deep_links": deep_links,
    "tracker_lookup": tracker_ids,
    "default_campaign": default_values,
    "lookup_duplicates": lookup_duplicates,
    "utm_url": utm_url,
    "uri_component": uri_component,
    "link_page": link_page(3),
    "link_page_first": link_page(1),
    "link_page_last": link_page(0),
    "link_page_past_the_end": link_page(-1),
    "app_link": app_link,
}

_DETAIL = f"CASE WHEN deeplink IN ('{LINK_NAMES[1]}', '{LINK_NAMES[2]}') THEN coalesce(additional_detail, '') ELSE '' END"
_BUILT = {
    **SQL,
    "built_links": f"""
    SELECT seq, CASE WHEN android_id IS NULL THEN 'Cannot create link: Please select valid platform and channel'
                     WHEN scheme IS NULL THEN 'Cannot create link: Please select deeplink type' END AS error,
           CASE WHEN android_id IS NOT NULL THEN 'https://exampleurl' || scheme || {_DETAIL} || '?adj_t=' || android_id ||
                '_' || ios_id || '&adj_deep_link=' || {_encode(f"example || {_DETAIL}")} || '&adj_campaign=' ||
                full_campaign || '&adj_adgroup=' || full_adgroup || '&adj_creative=' || full_creative ||
                '&adj_fallback=' || {_encode("fallback_url")} || '&adj_redirect_macos=' || {_encode("fallback_url")}
           END AS link
    FROM tracked_requests LEFT JOIN link_types ON name = deeplink""",
}
_UTM = ", ".join(
    f"CASE WHEN {value} <> '' THEN 'utm_{name}=' || replace({_encode(value)}, '%20', '+') END"
    for name, value in [
        ("campaign", "utm_campaign"),
        ("medium", "'qr'"),
        ("source", "utm_source"),
        ("content", sql_index(CONTENT, "event_id % 4")),
        ("term", sql_index(CAMPAIGNS, "event_id % 3")),
    ]
)


def _param(name):
    return f"""coalesce(url_decode(CASE WHEN url LIKE '%utm_campaign=c%' AND '{name}' = 'utm_campaign' THEN 'c'
        ELSE nullif(regexp_extract(url, '[?&]{name}=([^&#]*)', 1), '') END),
        CASE WHEN regexp_matches(url, '[?&]{name}=') THEN '' END, 'undefined')"""


ORACLE = {
    "deep_links": with_tables("SELECT * FROM built_links", _BUILT),
    "tracker_lookup": with_tables("SELECT seq, platform, channel, android_id, ios_id FROM tracked_requests", SQL),
    "default_campaign": with_tables(
        "SELECT seq, full_campaign AS campaign, full_adgroup AS adgroup, full_creative AS creative FROM tracked_requests",
        SQL,
    ),
    "lookup_duplicates": with_tables(
        f"""SELECT q.seq, p.android AS android_id, p.ios AS ios_id, coalesce(q.campaign, p.campaign, '') AS campaign,
        coalesce(q.adgroup, p.adgroup, '') AS adgroup, n.scheme AS "urlScheme", coalesce(n.adgroup, 'none') AS category,
        coalesce(s.ids, 'undefined') AS tracker_ids
        FROM link_requests q LEFT JOIN last_by_platform p ON p.pc = q.platform || ' - ' || q.channel
             LEFT JOIN last_by_name n ON n.name = q.deeplink
             JOIN (SELECT event_id, {SOURCE} AS source FROM touches) t ON t.event_id = q.seq
             LEFT JOIN last_by_source s ON s.place = t.source""",
        REPEATED,
    ),
    "utm_url": with_tables(
        f"SELECT event_id, url || CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END || concat_ws('&', {_UTM}) AS link FROM touches"
    ),
    "uri_component": f"""SELECT item_id, {_encode("text")} AS encoded, replace({_encode("text")}, '%20', '+') AS form_encoded
    FROM benchmark""",
    **{
        name: with_tables(
            f"""SELECT seq, link, n AS length, CAST(ceil(n / 10) AS BIGINT) AS total_pages, CAST({page} AS INTEGER) AS page
            FROM (SELECT seq, link, count(*) OVER () AS n, row_number() OVER (ORDER BY seq DESC) AS place
                  FROM built_links WHERE error IS NULL) WHERE (place - 1) // 10 + 1 = {page}""",
            _BUILT,
        )
        for name, page in [
            ("link_page", "3"), ("link_page_first", "1"), ("link_page_last", "ceil(n / 10)"), ("link_page_past_the_end", "ceil(n / 10) + 1"),
        ]
    },
    "app_link": with_tables(
        f"""SELECT event_id, device, 'https://links.example.com/store?campaign=' || {_param("utm_campaign")} || '_spring' ||
        CASE WHEN device = 'desktop' THEN '_QR_code' ELSE '' END || '&adgroup=' || {_param("utm_content")} ||
        '&creative=' || {_param("utm_term")} AS app_link
        FROM (SELECT *, {sql_index(DEVICES, "event_id % 5")} AS device FROM touches)"""
    ),
}
