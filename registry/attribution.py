"""Touch classification, first touch, tracker links and conversions.

The SQL side of a classification is the table of expected labels, not the rules again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_analytics.functions import urls
from campaign_analytics.plans import attribution as plan

from .tables import DEVICES, URLS, by_index, read, sql_index, touches, ts_text, with_tables

DETAILS = ["Awin", "Braze", "Facebook Organic", "Misc. Traffic", "Meta Paid", "Facebook Organic", "Linkedin Paid",
           "Linkedin Organic", "Linkedin Organic", "Google Ads Performance Max", "Google Organic Search",
           "Google Search Ads", "Instagram Organic", "Jobsora Ads", "Misc. Organic Search", "Misc. Organic Search",
           "Stepstone Ads", "Tiktok Organic", "Misc. Traffic", "Growth Testing", "Misc. Traffic", "Misc. Traffic",
           "Misc. Traffic", "Misc. Organic Search"]
INLINE_DETAILS = ["Awin", "Braze", "Facebook Organic", "Misc. Traffic", "Meta Paid", "Facebook Organic",
                  "Misc. Traffic", "Misc. Traffic", "Misc. Traffic", "Google Ads Performance Max", "Misc. Traffic",
                  "Google Search Ads", "Instagram Organic", "Jobsora Ads", "Misc. Traffic", "Misc. Traffic",
                  "Stepstone Ads", "Tiktok Organic", "Growth Testing", "Misc. Traffic", "Misc. Traffic",
                  "Misc. Traffic", "Awin", "Misc. Traffic"]
GROUPS = ["Affiliate", "CRM", "Organic Social", "Unknown/organic", "Paid Social", "Organic Social", "Paid Social",
          "Organic Social", "Organic Social", "Paid Search", "Organic Search", "Paid Search", "Organic Social",
          "Job boards", "Organic Search", "Organic Search", "Job boards", "Organic Social", "Unknown/organic",
          "Misc. Testing", "Unknown/organic", "Unknown/organic", "Unknown/organic", "Organic Search"]
# Expected source by page URL; None leaves it to the referrer.
BY_URL = ["google_ads", "google_ads", "facebook_ads", None, "stepstone_ads", "jobsora_ads", "organic_tiktok", None,
          None, None, None, "google_ads", None]
BY_URL_PAGE = ["google_ads", "google_ads", "facebook_ads", None, "stepstone_ads", "jobsora_ads", "organic_tiktok",
               None, None, None, "google_ads", "google_ads", None]
BY_URL_LEGACY = ["google_ads", None, None, "facebook_ads", "stepstone_ads", "indeed_ads", "organic_social", None, None,
                 None, None, "organic_social", None]
BY_REF = [None, "organic_search", "organic_search", "organic_search", None, None, None]
BY_REF_EQUAL = [None, "organic_search", None, "organic_search", None, None, None]
BY_REF_VIDEO = [None, "organic_search", None, "organic_search", None, None, "organic_search"]
LABELS = [None, "google", "google", "bing", "android-app://com", None, "youtube"]
PARAMS = {
    ("utm_source", "decoded"): [None, "google", "meta", None, "stepstone", "jobsora", "tiktok", None, None, "Unknown",
                                "awin", "Instagram", None],
    ("utm_source", "nullable"): [None, "google", "meta", None, "stepstone", "jobsora", "tiktok", None, None, "",
                                 "awin", "Instagram", None],
    ("utm_source", "form"): ["", "google", "meta", "", "stepstone", "jobsora", "tiktok", "", "", "", "awin",
                             "Instagram", ""],
    ("utm_campaign", "decoded"): [None, "a+b", "meta_q1", None, None, None, None, None, None, "c", None, None, "a+b"],
    ("utm_campaign", "nullable"): [None, "a b", "meta_q1", None, None, None, None, None, None, "c&d=e", None, None,
                                   "a+b"],
    ("utm_campaign", "form"): ["", "a b", "meta_q1", "", "", "", "", "", "", "c&d=e", "", "", "a+b"],
    ("utm_content", "decoded"): [None, None, "ad 1", None, None, None, None, None, None, None, None, None, ""],
    ("utm_content", "nullable"): [None, None, "ad 1", None, None, None, None, None, None, None, None, None, ""],
    ("utm_content", "form"): ["", "", "ad 1", "", "", "", "", "", "", "", "", "", ""],
}
MEDIUM = [None, "sem", "pfm", "cpm", "cpad", "cpc", "organic", None, None, None, None, "organic", None]
AWC = [None, None, None, None, None, None, None, None, "55_1", None, "77", None, None]
SOURCES = ["google_ads", "facebook_ads", "indeed_ads", "stepstone_ads", "organic_social", "organic_search",
           "website_clickout"]
PIXEL = "https://pixel.example.com/sread.img"
LINK_HOST = "https://links.example.com/"
DEFAULT_LINK = "https://links.example.com/default"


def _classified(**columns):
    def run(spark, d):
        t = touches(spark, d)
        return t.select("event_id", *[fn(t).alias(name) for name, fn in columns.items()])

    return run


def _detail(variant):
    return lambda t: plan.channel_detail(t.utm_source, t.utm_campaign, t.first_referrer, variant)


def channel(spark, d):
    t = touches(spark, d)
    details = t.select("event_id", _detail("tag_manager")(t).alias("a"), _detail("inline")(t).alias("b"))
    return details.select(
        "event_id",
        plan.channel(F.col("a")).alias("channel"),
        plan.channel(F.col("b"), "inline").alias("channel_inline"),
    )


def url_param(spark, d):
    t = touches(spark, d)
    return t.select(
        "event_id",
        *[urls.url_param(t.url, name, style).alias(f"{name}_{style}") for name, style in PARAMS],
        urls.url_param(t.url, "utm_source", "decoded", bare="true").alias("utm_source_true"),
    )


def page_urls(spark, d):
    """The crawled pages' own URLs."""
    url = F.col("url")
    return read(spark, d, "pages").select(
        "page_id",
        urls.host_label(url).alias("label"),
        urls.url_path(url).alias("path"),
        urls.url_param(url, "utm_source").alias("utm_source"),
        urls.url_param(url, "ref", "form").alias("ref"),
        urls.append_param(url, "ref", F.lit("mail")).alias("with_ref"),
    )


def _trackers(spark, d):
    source = by_index(SOURCES, "n_nationkey % 7")
    return read(spark, d, "nation").select(
        source.alias("source"),
        F.concat(F.lit("and"), F.col("n_nationkey").cast("string")).alias("android"),
        F.concat(F.lit("ios"), F.col("n_nationkey").cast("string")).alias("ios"),
        F.col("n_nationkey").alias("line"),
    )


# Put behind the pages' URLs: a bad escape, a parameter in the fragment, a repeated key, blanks, a bare key.
TAILS = ["gclid=50%off", "x=1#/y?gclid=frag", "gclid=a%20b&gclid=second", "gclid=a+b%2Bc?", "gclid", "xgclid=1"]


def search_params(spark, d):
    url = F.col("url")
    joined = F.concat(url, F.when(F.instr(url, "?") > 0, "&").otherwise("?"), by_index(TAILS, "page_id % 6"))
    return read(spark, d, "pages").select(
        "page_id", *[urls.url_param(joined, name, "search_params").alias(name) for name in ("gclid", "utm_source")]
    )


def tracker_link(variant):
    def run(spark, d):
        out = plan.tracker_link(touches(spark, d), _trackers(spark, d), LINK_HOST, variant, order="line")
        return out.select("event_id", "source", "tracker_url")

    return run


def sticky_tracker(spark, d):
    links = plan.tracker_link(touches(spark, d), _trackers(spark, d), LINK_HOST, order="line")
    known = links.withColumn("tracker_url", F.when(F.col("source").endswith("_ads"), F.col("tracker_url")))
    return plan.sticky_tracker(known, DEFAULT_LINK)


def first_touch(variant):
    return lambda spark, d: plan.first_touch(touches(spark, d), variant)


def channel_counts(spark, d):
    """Visits by channel, with each user's first referrer found first."""
    t = touches(spark, d).drop("first_referrer")
    return plan.with_channels(t, plan.first_touch(t)).groupBy("channel_detail", "channel").agg(
        F.count("*").alias("touches"), F.count_distinct("user_id").alias("users")
    )


def page_event(spark, d):
    return plan.page_event(touches(spark, d)).withColumn("ts", ts_text("ts"))


def affiliate_conversions(mode):
    return lambda spark, d: plan.affiliate_conversions(touches(spark, d), mode, PIXEL, "77")


QUERIES = {
    "channel_detail": _classified(channel_detail=_detail("tag_manager")),
    "channel_detail_inline": _classified(channel_detail=_detail("inline")),
    "channel": channel,
    "touch_source": _classified(
        source=lambda t: plan.touch_source(t.url, t.referrer),
        page_source=lambda t: plan.touch_source(t.url, t.referrer, "page_event"),
    ),
    "touch_source_legacy": _classified(
        **{v: lambda t, v=v: plan.touch_source_legacy(t.url, t.referrer, v) for v in ("qr", "qr_video", "engines_first")}
    ),
    "url_param": url_param,
    "page_urls": page_urls,
    "host_label": _classified(label=lambda t: urls.host_label(t.referrer)),
    "device_type": _classified(device=lambda t: urls.device_type(t.user_agent)),
    "first_touch": first_touch("signup"),
    "first_touch_website": first_touch("website"),
    "channel_counts": channel_counts,
    "search_params": search_params,
    "tracker_link": tracker_link("constant"),
    "tracker_link_term": tracker_link("term"),
    "sticky_tracker": sticky_tracker,
    "page_event": page_event,
    "affiliate_conversions": affiliate_conversions("tag"),
    "affiliate_conversions_pixel": affiliate_conversions("pixel"),
}

_SLOT, _URL, _REF = "event_id % 24", "event_id % 13", "event_id % 7"


def _labels(**columns):
    return "SELECT event_id, " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + " FROM events"


def _source(by_url, by_ref):
    return f"coalesce({sql_index(by_url, _URL)}, {sql_index(by_ref, _REF)}, 'website_clickout')"


def _param(name, style):
    return sql_index(PARAMS[name, style], _URL)


def _tracker(by_ref, tail_own, tail_paid):
    term = sql_index([v if v else "undefined" for v in [None] * 4 + ["t1"] + [None] * 8], _URL)
    return {
        "tracker_stage": f"""
    SELECT event_id, user_id, ts, source, '{LINK_HOST}and' || ids.n || '_ios' || ids.n || '?campaign=' ||
           CASE WHEN spot >= 4 THEN url || '&adgroup=' || coalesce(referrer, '') || '{tail_own}'
                ELSE coalesce({_param("utm_campaign", "decoded")}, 'undefined') || '&adgroup=' ||
                     coalesce({_param("utm_content", "decoded")}, 'undefined') || {tail_paid or "'&creative=' || " + term}
           END AS tracker_url
    FROM (SELECT *, list_position({SOURCES!r}, source) - 1 AS spot
          FROM (SELECT *, {_source(BY_URL_LEGACY, by_ref)} AS source FROM touches))
    JOIN (SELECT n_nationkey % 7 AS place, arg_max('' || n_nationkey, n_nationkey) AS n
          FROM nation GROUP BY place) ids ON place = spot"""
    }


SQL_SOURCE_LEGACY = _source(BY_URL_LEGACY, BY_REF_EQUAL)
_CONSTANT = _tracker(BY_REF_EQUAL, "&creative=qr", "'&creative=qr'")
SQL_STORED = f"coalesce({sql_index(['partner' if 'first_ref' in u else None for u in URLS], _URL)}, {sql_index(LABELS, _REF)})"
_CONVERSION = """'1' AS amount, 'aw' AS channel, 'Default:1' AS parts, 'EUR' AS currency, 'null' AS voucher,
    '1' AS test"""
_TRUE_SOURCE = sql_index(["true" if v == "Unknown" else v for v in PARAMS["utm_source", "decoded"]], _URL)



def _search_param(name):
    return f"""CASE WHEN regexp_matches(q, '&{name}(=|&|$)') THEN url_decode(replace(substr(
        regexp_extract(q, '(&{name}(=[^&]*)?)(&|$)', 1), {len(name) + 3}), '+', ' ')) END AS {name}"""


ORACLE = {
    "channel_detail": _labels(channel_detail=sql_index(DETAILS, _SLOT)),
    "channel_detail_inline": _labels(channel_detail=sql_index(INLINE_DETAILS, _SLOT)),
    "channel": _labels(
        channel=sql_index(GROUPS, _SLOT),
        channel_inline=sql_index([GROUPS[DETAILS.index(detail)] for detail in INLINE_DETAILS], _SLOT),
    ),
    "touch_source": _labels(
        source=_source(BY_URL, BY_REF), page_source=f"coalesce({sql_index(BY_URL_PAGE, _URL)}, 'organic_search')"
    ),
    "touch_source_legacy": _labels(
        qr=_source(BY_URL_LEGACY, BY_REF_EQUAL),
        qr_video=_source(BY_URL_LEGACY, BY_REF_VIDEO),
        engines_first=f"coalesce({sql_index(BY_REF_EQUAL, _REF)}, {sql_index(BY_URL_LEGACY, _URL)}, 'website_clickout')",
    ),
    "url_param": _labels(
        **{f"{name}_{style}": _param(name, style) for name, style in PARAMS}, utm_source_true=_TRUE_SOURCE
    ),
    "page_urls": """
    SELECT page_id, split_part(regexp_replace(url, '^https?://(www\\.)?', ''), '.', 1) AS label,
           regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1) AS path,
           CASE WHEN url LIKE '%utm_source=feed%' THEN 'feed' END AS utm_source,
           CASE WHEN url LIKE '%&ref=x%' THEN 'x' ELSE '' END AS ref,
           CASE WHEN url LIKE '%ref=%' THEN url WHEN url LIKE '%?%' THEN url || '&ref=mail' ELSE url || '?ref=mail' END
               AS with_ref
    FROM pages""",
    "host_label": _labels(label=sql_index(LABELS, _REF)),
    "device_type": _labels(device=sql_index(DEVICES, "event_id % 5")),
    "first_touch": with_tables(
        f"""SELECT user_id, arg_min({SQL_STORED}, (ts, event_id)) FILTER (WHERE {SQL_STORED} IS NOT NULL) AS first_referrer
        FROM touches GROUP BY user_id"""
    ),
    "first_touch_website": with_tables(
        f"""SELECT user_id, arg_min(coalesce({sql_index(LABELS, _REF)}, 'null'), (ts, event_id)) AS first_referrer
        FROM touches GROUP BY user_id"""
    ),
    "channel_counts": with_tables(
        f"""
    SELECT channel_detail, CASE channel_detail WHEN 'Awin' THEN 'Affiliate' WHEN 'Facebook Organic' THEN 'Organic Social'
           WHEN 'Meta Paid' THEN 'Paid Social' WHEN 'Google Organic Search' THEN 'Organic Search'
           WHEN 'Misc. Organic Search' THEN 'Organic Search' WHEN 'Linkedin Organic' THEN 'Organic Social'
           WHEN 'Jobsora Ads' THEN 'Job boards' WHEN 'Stepstone Ads' THEN 'Job boards'
           WHEN 'Tiktok Organic' THEN 'Organic Social' ELSE 'Unknown/organic' END AS channel,
           count(*) AS touches, count(DISTINCT user_id) AS users
    FROM (SELECT user_id, CASE src WHEN 'awin' THEN 'Awin' WHEN 'meta' THEN 'Meta Paid' WHEN 'jobsora' THEN 'Jobsora Ads'
              WHEN 'stepstone' THEN 'Stepstone Ads' WHEN 'tiktok' THEN 'Tiktok Organic'
              ELSE CASE WHEN src IS NOT NULL THEN 'Misc. Traffic' WHEN ref = 'google' THEN 'Google Organic Search'
                        ELSE 'Misc. Organic Search' END END AS channel_detail
          FROM (SELECT user_id, {_param("utm_source", "nullable")} AS src, ref FROM touches
                JOIN (SELECT user_id AS owner, arg_min({SQL_STORED}, (ts, event_id)) FILTER (WHERE {SQL_STORED} IS NOT NULL) AS ref
                      FROM touches GROUP BY user_id) ON owner = user_id))
    GROUP BY ALL"""
    ),
    "search_params": f"""
    SELECT page_id, {_search_param("gclid")}, {_search_param("utm_source")}
    FROM (SELECT page_id, '&' || regexp_extract(split_part(u, '#', 1), '\\?(.*)$', 1) AS q
          FROM (SELECT page_id, url || CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END || {sql_index(TAILS, "page_id % 6")} AS u
                FROM pages))""",
    "tracker_link": with_tables("SELECT event_id, source, tracker_url FROM tracker_stage", _CONSTANT),
    "tracker_link_term": with_tables(
        "SELECT event_id, source, tracker_url FROM tracker_stage", _tracker(BY_REF_VIDEO, "", None)
    ),
    "sticky_tracker": with_tables(
        f"""SELECT user_id, coalesce(arg_min(tracker_url, (ts, event_id)) FILTER (WHERE source LIKE '%\\_ads' ESCAPE '\\'),
        '{DEFAULT_LINK}') AS tracker_url FROM tracker_stage GROUP BY user_id""",
        _CONSTANT,
    ),
    "page_event": with_tables(
        f"""
    SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           {sql_index(["/jobs" if "/jobs" in u else "/x/y" if "/x/y" in u else "/" for u in URLS], _URL)} AS name,
           {sql_index(AWC, _URL)} AS awc, {sql_index(["1"] + [None] * 12, _URL)} AS gclid,
           {sql_index([None] * 10 + ["G-1", None, None], _URL)} AS gbraid,
           {sql_index([None] * 3 + ["abc"] + [None] * 9, _URL)} AS fbclid, CAST(NULL AS VARCHAR) AS fbc,
           CAST(NULL AS VARCHAR) AS fbp, coalesce({sql_index(BY_URL_PAGE, _URL)}, 'organic_search') AS marketing_source
    FROM touches"""
    ),
    "affiliate_conversions": with_tables(
        f"""SELECT event_id, user_id AS order_ref, {_CONVERSION}, {_TRUE_SOURCE} AS source,
        {sql_index(MEDIUM, _URL)} AS medium, {_param("utm_campaign", "decoded")} AS campaign,
        {sql_index(AWC, _URL)} AS awc_param FROM touches"""
    ),
    "affiliate_conversions_pixel": with_tables(
        f"""SELECT *, '{PIXEL}?tt=ss&tv=2&merchant=77&amount=1&ch=aw&parts=DEFAULT:1&ref=' ||
        order_ref || '&vc=0&cr=EUR&testmode=1&cks=' || awc_param AS pixel_url FROM (
        SELECT event_id, user_id AS order_ref, {_CONVERSION}, coalesce({_TRUE_SOURCE}, 'undefined') AS source,
        coalesce({sql_index(MEDIUM, _URL)}, 'undefined') AS medium,
        coalesce({_param("utm_campaign", "decoded")}, 'undefined') AS campaign,
        coalesce({sql_index(AWC, _URL)}, 'undefined') AS awc_param FROM touches)"""
    ),
}
