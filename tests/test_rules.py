"""Column functions against their rule tables, with nulls, blanks and case."""

import datetime

import pytest
from pyspark.sql import functions as F

from campaign_analytics.functions import dates, identity, text, urls
from campaign_analytics.operators import filters
from campaign_analytics.plans import attribution, experiments, leads, links, surveys


def values(spark, schema, rows, *columns):
    """Evaluate columns over a small table and return one tuple per row, in order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
    return [tuple(r) for r in df.orderBy("_i").select(*columns).collect()]


def one(spark, schema, rows, column):
    return [v for (v,) in values(spark, schema, rows, column)]


CHANNELS = [
    ("awin", "x", None, "Awin", "Affiliate", "Awin"),
    ("braze", "x", None, "Braze", "CRM", "Braze"),
    ("meta", "spring", None, "Facebook Organic", "Organic Social", "Facebook Organic"),
    ("meta", None, None, "Facebook Organic", "Organic Social", "Facebook Organic"),
    ("facebook", "meta_spring", None, "Misc. Traffic", "Unknown/organic", "Misc. Traffic"),
    ("meta", "META_spring", None, "Meta Paid", "Paid Social", "Meta Paid"),
    ("meta", "metaspring", None, "Facebook Organic", "Organic Social", "Facebook Organic"),
    ("linkedin", "linkedin_q1", None, "Linkedin Paid", "Paid Social", "Misc. Traffic"),
    ("linkedin", "q1", None, "Linkedin Organic", "Organic Social", "Misc. Traffic"),
    (None, None, "linkedin", "Linkedin Organic", "Organic Social", "Misc. Traffic"),
    ("google-search", "pmax_de", None, "Google Ads Performance Max", "Paid Search", "Google Ads Performance Max"),
    (None, None, "google", "Google Organic Search", "Organic Search", "Misc. Traffic"),
    ("google-search", "brand", None, "Google Search Ads", "Paid Search", "Google Search Ads"),
    ("google-search", None, None, "Google Search Ads", "Paid Search", "Google Search Ads"),
    ("instagram", "x", None, "Instagram Organic", "Organic Social", "Instagram Organic"),
    ("jobsora", "x", None, "Jobsora Ads", "Job boards", "Jobsora Ads"),
    (None, None, "bing", "Misc. Organic Search", "Organic Search", "Misc. Traffic"),
    (None, None, None, "Misc. Organic Search", "Organic Search", "Misc. Traffic"),
    ("stepstone", "x", None, "Stepstone Ads", "Job boards", "Stepstone Ads"),
    ("tiktok", "x", None, "Tiktok Organic", "Organic Social", "Tiktok Organic"),
    ("tiktok", "tiktok_x", None, "Misc. Traffic", "Unknown/organic", "Growth Testing"),
    ("test_radio", "x", None, "Growth Testing", "Misc. Testing", "Misc. Traffic"),
    ("newsletter", "x", None, "Misc. Traffic", "Unknown/organic", "Misc. Traffic"),
    ("", None, "google", "Misc. Traffic", "Unknown/organic", "Misc. Traffic"),
    ("AWIN", "x", None, "Misc. Traffic", "Unknown/organic", "Awin"),
]


def test_channel_rules(spark):
    args = (F.col("u"), F.col("c"), F.col("r"))
    detail = attribution.channel_detail(*args)
    got = values(
        spark, "u string, c string, r string", [row[:3] for row in CHANNELS],
        detail, attribution.channel(detail), attribution.channel_detail(*args, variant="inline"),
    )
    assert got == [row[3:] for row in CHANNELS]


def test_channel_groups_outside_the_rules(spark):
    details = [("Misc. Refferal Traffic",), ("Misc. Referral Traffic",), ("Self Referring",), (None,), ("Linkedin Paid",), ("growth testing",)]
    got = values(
        spark, "d string", details, attribution.channel(F.col("d")), attribution.channel(F.col("d"), "inline")
    )
    assert got == [("Unknown/organic",) * 2, (None, None), (None, None), (None, None), ("Paid Social", None), (None, None)]


SOURCES = [
    ("https://e.com/?gclid=1", None, "google_ads", "google_ads", "google_ads"),
    ("https://e.com/?utm_source=google&utm_medium=sem", None, "google_ads", "website_clickout", "google_ads"),
    ("https://e.com/?utm_source=meta&utm_medium=pfm", None, "facebook_ads", "website_clickout", "facebook_ads"),
    ("https://e.com/?utm_medium=cpm", None, "website_clickout", "facebook_ads", "organic_search"),
    ("https://e.com/?utm_source=stepstone&utm_medium=cpad", None, "stepstone_ads", "stepstone_ads", "stepstone_ads"),
    ("https://e.com/?utm_medium=cpc&utm_source=jobsora", None, "jobsora_ads", "indeed_ads", "jobsora_ads"),
    ("https://e.com/?utm_source=tiktok&utm_medium=organic", None, "organic_tiktok", "organic_social", "organic_tiktok"),
    ("https://e.com/", "https://www.google.com/", "organic_search", "organic_search", "organic_search"),
    ("https://e.com/", "https://www.google.com/search?q=x", "organic_search", "website_clickout", "organic_search"),
    ("https://e.com/", None, "website_clickout", "website_clickout", "organic_search"),
    ("https://e.com/?GBRAID=1", None, "website_clickout", "website_clickout", "google_ads"),
    (None, None, "website_clickout", "website_clickout", "organic_search"),
]


def test_touch_sources(spark):
    url, ref = F.col("url"), F.col("ref")
    got = values(
        spark, "url string, ref string", [row[:2] for row in SOURCES], attribution.touch_source(url, ref),
        attribution.touch_source_legacy(url, ref), attribution.touch_source(url, ref, "page_event"),
    )
    assert got == [row[2:] for row in SOURCES]


def test_legacy_variants_differ_in_engines_and_boards(spark):
    rows = [
        ("https://e.com/?x=stellenwerk", None),
        ("https://e.com/?gclid=1", "https://www.bing.com/"),
        ("https://e.com/", "https://www.youtube.com/"),
    ]
    got = values(
        spark, "url string, ref string", rows,
        *[attribution.touch_source_legacy(F.col("url"), F.col("ref"), v) for v in ("qr", "qr_video", "engines_first")],
    )
    assert got == [
        ("website_clickout", "website_clickout", "stellenwerk_ads"),
        ("google_ads", "google_ads", "organic_search"),
        ("website_clickout", "organic_search", "website_clickout"),
    ]


def test_touch_referrer_variants(spark):
    rows = [
        ("https://e.com/?first_ref=partner", "https://www.google.com/"),
        ("https://e.com/?first_ref=", "https://www.google.com/"),
        ("https://e.com/", None),
    ]
    got = values(
        spark, "url string, ref string", rows,
        *[attribution.touch_referrer(F.col("url"), F.col("ref"), v) for v in ("signup", "website")],
    )
    assert got == [("partner", "google"), ("google", "google"), (None, "null")]


@pytest.mark.parametrize(
    ("url", "decoded", "form", "nullable"),
    [
        ("https://e.com/?a=1&a=2", "1", "1", "1"),
        ("https://e.com/?a", "Unknown", "", ""),
        ("https://e.com/?a&b=1", "Unknown", "", ""),
        ("https://e.com/?a=", "", "", ""),
        ("https://e.com/?b=1", None, "", None),
        ("https://e.com/", None, "", None),
        ("https://e.com/?xa=1", None, "", None),
        ("https://e.com/?a=x+y%20z", "x+y z", "x y z", "x y z"),
        ("https://e.com/?a=1%26b=2", "1", "1&b=2", "1&b=2"),
        ("https://e.com/?a=p=q", "p", "p=q", "p=q"),
        ("https://e.com/?c=1&a=%C3%A4#a=2", "ä", "ä", "ä"),
        ("https://e.com/#?a=1", None, "", "1"),
        (None, None, "", None),
    ],
)
def test_url_param(spark, url, decoded, form, nullable):
    styles = [urls.url_param(F.col("u"), "a", style) for style in ("decoded", "form", "nullable")]
    assert values(spark, "u string", [(url,)], *styles) == [(decoded, form, nullable)]


@pytest.mark.parametrize(
    ("url", "value"),
    [
        ("https://e.com/?a=50%off", "50%off"),
        ("https://e.com/?a=%C3%A4+%2B%", "ä +%"),
        ("https://e.com/#/x?a=frag", None),
        ("https://e.com/?b=1#?a=frag", None),
        ("https://e.com/?b=1?a=2", None),
        ("https://e.com/?a=1&a=2", "1"),
        ("https://e.com/?b&a&c=1", ""),
        ("https://e.com/?a=p=q?r", "p=q?r"),
        ("https://e.com/", None),
        (None, None),
    ],
)
def test_search_params(spark, url, value):
    assert values(spark, "u string", [(url,)], urls.url_param(F.col("u"), "a", "search_params")) == [(value,)]


def test_malformed_escape_gives_no_value(spark):
    styles = [urls.url_param(F.col("u"), "a", style) for style in ("decoded", "form", "nullable")]
    assert values(spark, "u string", [("https://e.com/?a=%zz",)], *styles) == [(None, "", None)]


def test_host_label(spark):
    cases = {
        "https://www.google.com/": "google",
        "http://m.example.net/x": "m",
        "www.bing.com": "bing",
        "android-app://com.google": "android-app://com",
        "localhost/": None,
        "": None,
        None: None,
    }
    assert one(spark, "r string", [(r,) for r in cases], urls.host_label(F.col("r"))) == list(cases.values())


def test_append_param(spark):
    rows = [("https://e.com", "x"), ("https://e.com?a=1", "x"), ("https://e.com?ref=1", "x"), ("https://e.com", None)]
    got = one(spark, "u string, v string", rows, urls.append_param(F.col("u"), "ref", F.col("v")))
    assert got == ["https://e.com?ref=x", "https://e.com?a=1&ref=x", "https://e.com?ref=1", "https://e.com"]


def test_encoding(spark):
    rows = [("app://offers/a b+c~(x)!ä",), ("it's*",), ("",), (None,)]
    got = values(spark, "t string", rows, urls.uri_component(F.col("t")), urls.form_component(F.col("t")))
    assert got == [
        ("app%3A%2F%2Foffers%2Fa%20b%2Bc~(x)!%C3%A4", "app%3A%2F%2Foffers%2Fa+b%2Bc~(x)!%C3%A4"),
        ("it's*", "it's*"),
        ("", ""),
        (None, None),
    ]


def test_web_origin(spark):
    rows = ["google / organic", "(direct) / (none)", "google / cpc", "(not set)", "(not set) / (not set)", None]
    got = one(spark, "s string", [(r,) for r in rows], filters.web_origin(F.col("s")))
    assert got == ["Organic", "Organic", "Paid", "Paid", "Paid", "Paid"]


def test_campaign_filter_modes(spark):
    df = spark.createDataFrame([("B2B_x",), ("b2b_B2C",), ("other",), (None,), ("b2b_old",)], "campaign string")

    def kept(exclude, mode):
        return {r.campaign for r in filters.campaign_filter(df, ["b2b"], exclude, mode).collect()}

    assert kept(["b2c"], "any") == kept(["b2c"], "all") == {"B2B_x", "b2b_old"}
    assert kept(["b2c", "old"], "any") == {"B2B_x", "b2b_B2C", "b2b_old"}
    assert kept(["b2c", "old"], "all") == {"B2B_x"}


def test_dates(spark):
    ts = datetime.datetime
    rows = [(ts(2024, 7, 1, 10),), (ts(2024, 1, 1, 23, 5, 9),), (ts(2024, 3, 31, 1),)]
    assert one(spark, "t timestamp_ntz", rows, dates.berlin_time(F.col("t"))) == [
        "1.7.2024, 12:00:00", "2.1.2024, 00:05:09", "31.3.2024, 03:00:00",
    ]
    assert one(spark, "t timestamp_ntz", rows[:1], dates.iso_utc(F.col("t"))) == ["2024-07-01T10:00:00.000Z"]
    days = [("2024-07-03",), ("2024-07-07",), ("2024-07-01",)]
    assert one(spark, "d string", days, dates.last_full_week_end(F.col("d").cast("date")).cast("string")) == [
        "2024-06-30", "2024-06-30", "2024-06-30",
    ]
    assert one(spark, "d string", [("20240229",), ("x",), (None,)], dates.compact_date(F.col("d")).cast("string")) == [
        "2024-02-29", None, None,
    ]


def test_range_ends_at_midnight(spark):
    ts = datetime.datetime
    rows = [(ts(2024, 1, 2),), (ts(2024, 1, 2, 0, 0, 1),), (ts(2023, 11, 2),), (ts(2023, 11, 1, 23, 59),)]
    got = one(spark, "t timestamp_ntz", rows, dates.within_days(F.col("t"), "2024-01-01", 60, 1))
    assert got == [True, False, True, False]


def test_text(spark):
    assert one(spark, "t string", [("u1",)], identity.pseudonym(F.col("t"), "salt")) == [
        "f9ae7b1cbfe50baf3c62a789384fd378f2f8fef693d1f682a6ecaaaee285b595"
    ]
    mails = {"a@b.c": True, "a@b": False, "a b@c.d": False, "": False, None: False, "a@@b.c": False, "a@b.c\n": False}
    assert one(spark, "t string", [(m,) for m in mails], text.valid_email(F.col("t"))) == list(mails.values())
    lengths = [(" ",), ("x" * 255,), (" " + "x" * 255 + "\n",), ("x" * 256,), (None,)]
    assert one(spark, "t string", lengths, text.trim_len_ok(F.col("t"))) == [False, True, True, False, False]
    names = [("Ann",), (" ",), (None,)]
    assert one(spark, "t string", names, text.greeting(F.col("t"))) == ["Hey Ann,", "Hey,", "Hey,"]
    flags = [("true",), ("TRUE",), (None,)]
    assert one(spark, "t string", flags, text.truthy(F.col("t"))) == [True, False, False]
    assert one(spark, "t string", [("it's",)], text.sql_escape(F.col("t"))) == ["it''s"]
    assert one(spark, "r double", [(0.12345,), (0.5,), (None,)], text.pct_text(F.col("r"))) == ["12.35%", "50.00%", None]
    assert one(spark, "n int", [(3,), (0,), (-1,), (None,)], text.rating_event(F.col("n"))) == ["UserRatedApp3", None, None, None]
    events = [("UserRatedApp4",), ("UserRatedApp",), ("x",), (None,)]
    assert one(spark, "e string", events, text.rating_of(F.col("e"))) == [4, None, None, None]


def test_device(spark):
    agents = ["x ANDROID y", "iPhone", "iPod", "X11", None]
    assert one(spark, "a string", [(a,) for a in agents], urls.device_type(F.col("a"))) == [
        "android", "ios", "ios", "desktop", "desktop",
    ]


def test_significance(spark):
    cases = [
        ((1000, 100), (1000, 130), 2.102741, "Significant"),
        ((1000, 100), (1000, 110), 0.729422, "Not significant"),
        ((500, 100), (500, 60), -3.450328, "Significant"),
        ((0, 0), (100, 10), None, "Not significant"),
        ((100, 0), (100, 0), None, "Not significant"),
    ]
    rows = []
    for i, (control, test, _, _) in enumerate(cases):
        rows += [(f"{i}", "control", True, *control), (f"{i}", "B", False, *test)]
    df = spark.createDataFrame(rows, "test_id string, group_name string, is_control boolean, users long, conversions long")
    got = {r.test_id: r for r in experiments.ab_significance(df).collect()}
    for i, (_, _, z, result) in enumerate(cases):
        row = got[f"{i}"]
        assert (row.z is None) == (z is None) and (z is None or abs(row.z - z) < 1e-6)
        assert row.result == result


def test_group_sizes(spark):
    df = spark.createDataFrame([("a", 20), ("a", 80), ("b", 20), ("b", 70)], "test_id string, percent int")
    got = {r.test_id: r.message for r in experiments.group_size_check(df).collect()}
    assert got == {"a": "ok", "b": "Group percentages must add up to 100"}


def test_scores_and_routes(spark):
    scores = [(10,), (9,), (8,), (7,), (6,), (1,)]
    assert one(spark, "s int", scores, surveys.nps_bucket(F.col("s"))) == ["high", "high", "middle", "middle", "low", "low"]
    rows = [(1, " too slow "), (2, " "), (2, "x" * 256), (3, "ignored"), (1, None)]
    df = spark.createDataFrame(rows, "rating int, feedback string")
    assert [tuple(r)[1:] for r in surveys.survey_route(df).collect()] == [
        ("too slow", "rating_with_feedback"), (None, "ask_feedback"), (None, "ask_feedback"), (None, "rating_only"),
        (None, "ask_feedback"),
    ]


def test_leads(spark):
    good = dict(
        first_name="A", last_name="B", email="a@b.c", phone="1", company="C", zip="12345", industry="Hotels",
        callback="Ja", bedarf__c="x",
    )
    cases = [
        ({}, None), ({"phone": " ", "email": "bad"}, leads.EMPTY_FIELD), ({"zip": "123456"}, leads.BAD_ZIP),
        ({"industry": leads.PLACEHOLDER}, leads.EMPTY_FIELD), ({"company": leads.PLACEHOLDER}, None),
        ({"email": "bad", "zip": "123456"}, leads.BAD_EMAIL), ({"zip": None}, leads.EMPTY_FIELD),
    ]
    schema = ", ".join(f"{name} string" for name in good)
    df = spark.createDataFrame([tuple({**good, **change}.values()) for change, _ in cases], schema)
    assert [r.first_error for r in leads.validate_leads(df).collect()] == [want for _, want in cases]
    short = spark.createDataFrame(
        [tuple({**good, **c}.values()) for c in ({"company": " "}, {"email": ""}, {"email": " a@b.c "})], schema
    )
    assert [r.first_error for r in leads.validate_leads(short, "short").collect()] == [None, leads.BAD_EMAIL, None]


def test_utm_url(spark):
    rows = [
        ("https://e.com", "a b", None, "s", "", "t&1"), ("https://e.com?x=1", "c", "m", None, None, None),
        ("https://e.com", None, "", None, None, None),
    ]
    schema = "b string, c string, m string, s string, o string, t string"
    got = one(spark, schema, rows, links.utm_url(*[F.col(c) for c in "bcmsot"]))
    assert got == [
        "https://e.com?utm_campaign=a+b&utm_source=s&utm_term=t%261", "https://e.com?x=1&utm_campaign=c&utm_medium=m",
        "https://e.com",
    ]


def test_preference_choice_is_a_coalesce(spark):
    options = [None, "a", "b"]
    rows = [(w, a, s, e) for w in options for a in options for s in options for e in options]
    picked = filters.choose_preference(*[F.col(c) for c in "wase"])
    got = one(spark, "w string, a string, s string, e string", rows, picked)
    assert got == [next((v for v in (a, w, s, e) if v is not None), None) for w, a, s, e in rows]
