"""Attribution of page touches: channel, source, first referrer, tracker links, conversions.

Touches have ``user_id``, ``ts``, ``event_id``, ``url`` and ``referrer``. Classification is a chain of
column expressions and moves no rows; first-touch results need one shuffle by user, after a
map-side reduction to one row per user and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of, equals, matches
from ..functions.text import contains_ci
from ..functions.urls import (
    SEARCH_AND_VIDEO,
    SEARCH_ENGINES,
    equals_any,
    host_label,
    starts_with_any,
    url_param,
    url_path,
)
from ..operators.joins import one_per_key
from ..operators.windows import first_over

TOUCH_ORDER = ["ts", "event_id"]


def _first_match(rules: list[tuple[str, Column]], otherwise: Column) -> Column:
    """Label of the first rule that holds, as one flat CASE."""
    (label, condition), *rest = rules
    out = F.when(condition, F.lit(label))
    for label, condition in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(otherwise)


def channel_detail(
    utm_source: Column, utm_campaign: Column, first_referrer: Column, variant: str = "tag_manager"
) -> Column:
    """Channel detail of a visit; the order of the rules decides.

    ``tag_manager`` compares the source as it is and knows untagged visits by a missing source.
    ``inline`` lowers source and campaign and reads a missing one as empty, so that an untagged
    visit is miscellaneous traffic; it has no Linkedin rules.
    """
    inline = variant == "inline"
    if not inline and variant != "tag_manager":
        raise ValueError(f"unknown variant {variant!r}")
    source = F.lower(F.coalesce(utm_source, F.lit(""))) if inline else utm_source
    untagged = source.isNull()

    def is_source(*names: str) -> Column:
        return any_of([equals(source, name) for name in names])

    def campaign(pattern: str) -> Column:
        return matches(utm_campaign, pattern)

    def referrer(pattern: str) -> Column:
        return matches(first_referrer, pattern)

    linkedin = [
        ("Linkedin Paid", is_source("linkedin") & campaign("linkedin")),
        ("Linkedin Organic", is_source("linkedin") | (untagged & referrer("linkedin"))),
    ]
    testing = is_source("tiktok") & campaign("tiktok_") if inline else matches(source, "test_")
    rules = [
        ("Awin", is_source("awin")),
        ("Braze", is_source("braze")),
        ("Facebook Organic", is_source("meta", "facebook") & ~campaign("meta_")),
        ("Meta Paid", is_source("meta") & campaign("meta")),
        *([] if inline else linkedin),
        ("Google Ads Performance Max", is_source("google-search") & campaign("pmax")),
        ("Google Search Ads", is_source("google-search")),
        ("Google Organic Search", untagged & referrer("google")),
        ("Misc. Organic Search", untagged),
        ("Instagram Organic", is_source("instagram")),
        ("Jobsora Ads", is_source("jobsora")),
        ("Stepstone Ads", is_source("stepstone")),
        ("Tiktok Organic", is_source("tiktok") & ~campaign("tiktok_")),
        ("Growth Testing", testing),
    ]
    return _first_match(rules, F.lit("Misc. Traffic"))


# Channel groups and the details they take in. The first three groups need the exact
# detail; the others take any detail containing one of the names.
EXACT_CHANNELS = {"Affiliate": "Awin", "CRM": "Braze", "Misc. Testing": "Growth Testing"}
CHANNELS = {
    "Organic Social": ["Facebook Organic", "Instagram Organic", "Tiktok Organic", "Linkedin Organic"],
    "Paid Social": ["Meta Paid", "Linkedin Paid"],
    "Paid Search": ["Google Ads Performance Max", "Google Search"],
    "Organic Search": ["Google Organic Search", "Misc. Organic Search"],
    "Job boards": ["Jobsora", "Stepstone"],
    "Unknown/organic": ["Misc. Traffic", "Misc. Refferal Traffic", "Unknown"],
}


def channel(detail: Column, variant: str = "tag_manager") -> Column:
    """Channel group of a detail, null for a detail outside every group."""
    rules = [(group, equals(detail, name)) for group, name in EXACT_CHANNELS.items()]
    for group, names in CHANNELS.items():
        if variant == "inline":
            names = [name for name in names if not name.startswith("Linkedin")]
        rules.append((group, any_of([contains_ci(detail, name) for name in names])))
    return _first_match(rules, F.lit(None).cast("string"))


# Words in a URL that tell its source, ignoring case, in order of precedence. Of a
# pair, the second word has to follow the first one somewhere.
SOURCE_WORDS = {
    "google_ads": ["gclid", ("google", "uac"), ("google", "sem"), ("google", "gdn"), ("google", "yta")],
    "facebook_ads": [("meta", "pfm"), ("meta", "awa")],
    "stepstone_ads": [("stepstone", "cpad")],
    "jobsora_ads": [("jobsora", "cpc"), ("cpc", "jobsora")],
    "organic_instagram": [("instagram", "organic"), ("organic", "instagram")],
    "organic_tiktok": [("tiktok", "organic"), ("organic", "tiktok")],
    "organic_youtube": [("youtube", "organic"), ("organic", "youtube")],
}


def _has_words(text: Column, words: str | tuple[str, str]) -> Column:
    """Plain substring searches, which cost a fraction of a pattern with a gap in it."""
    if isinstance(words, str):
        return text.contains(words)
    first, second = words
    rest = F.instr(text, first) + len(first)
    return text.contains(first) & (F.call_function("locate", F.lit(second), text, rest) > 0)


def touch_source(url: Column, referrer: Column, variant: str = "tag_manager") -> Column:
    """Source of a touch from its URL, else from its referrer.

    The ``page_event`` variant also knows ``gbraid`` and calls everything else organic search.
    """
    page_event = variant == "page_event"
    link = F.lower(F.coalesce(url, F.lit("")))
    rules = []
    for source, choices in SOURCE_WORDS.items():
        extra = ["gbraid"] if page_event and source == "google_ads" else []
        rules.append((source, any_of([_has_words(link, words) for words in extra + choices])))
    if page_event:
        return _first_match(rules, F.lit("organic_search"))
    rules.append(("organic_search", starts_with_any(referrer)))
    return _first_match(rules, F.lit("website_clickout"))


# Words looked for in the URL, in order of precedence.
LEGACY_WORDS = {
    "google_ads": "gclid",
    "facebook_ads": "cpm",
    "indeed_ads": "cpc",
    "stepstone_ads": "stepstone",
    "stellenwerk_ads": "stellenwerk",
    "stellenticket_ads": "stellenticket",
    "organic_social": "organic",
}
EXTRA_BOARDS = ["stellenwerk_ads", "stellenticket_ads"]


def touch_source_legacy(url: Column, referrer: Column, variant: str = "qr") -> Column:
    """Source by plain words in the URL; referrers count only when equal to an engine's URL.

    ``qr_video`` takes two video sites for engines. ``engines_first`` looks at the referrer before
    the URL and knows two more job boards.
    """
    engines_first = variant == "engines_first"
    engine = equals_any(referrer, SEARCH_AND_VIDEO if variant == "qr_video" else SEARCH_ENGINES)
    link = F.coalesce(url, F.lit(""))
    words = [
        (source, link.contains(word))
        for source, word in LEGACY_WORDS.items()
        if engines_first or source not in EXTRA_BOARDS
    ]
    search = [("organic_search", engine)]
    return _first_match(search + words if engines_first else words + search, F.lit("website_clickout"))


def touch_referrer(url: Column, referrer: Column, variant: str = "signup") -> Column:
    """What one touch would store as first referrer; null when it stores nothing.

    ``website`` stores the referrer's label, or the text ``null`` when there is none. ``signup``
    takes the label carried on the URL, else the referrer's.
    """
    label = host_label(F.coalesce(referrer, F.lit("")))
    if variant == "website":
        return F.coalesce(label, F.lit("null"))
    if variant == "signup":
        return F.coalesce(F.nullif(url_param(url, "first_ref", "search_params"), F.lit("")), F.nullif(label, F.lit("")))
    raise ValueError(f"unknown variant {variant!r}")


def first_touch(touches: DataFrame, variant: str = "signup") -> DataFrame:
    """First stored referrer of every user."""
    stored = touch_referrer(F.col("url"), F.col("referrer"), variant)
    return first_over(touches, ["user_id"], stored, TOUCH_ORDER, "first_referrer")


def with_channels(touches: DataFrame, first: DataFrame) -> DataFrame:
    """Touches with their user's first referrer, channel detail and channel.

    The campaign parameters are columns of their own before the join, so each is parsed once per
    touch and not once per rule.
    """
    tagged = touches.withColumns(
        {f"utm_{name}": url_param(F.col("url"), f"utm_{name}") for name in ("source", "campaign")}
    )
    detail = channel_detail(F.col("utm_source"), F.col("utm_campaign"), F.col("first_referrer"))
    return (
        tagged.join(first, "user_id", "left")
        .withColumn("channel_detail", detail)
        .withColumn("channel", channel(F.col("channel_detail")))
    )


OWN_PAGE_SOURCES = ["organic_social", "organic_search", "website_clickout"]


def tracker_link(
    touches: DataFrame,
    trackers: DataFrame,
    base_url: str,
    variant: str = "constant",
    creative: str = "qr",
    order: str | None = None,
) -> DataFrame:
    """Tracking URL of a touch from its source's tracker ids.

    Unpaid sources carry page and referrer, paid ones their campaign parameters. The ``constant``
    variant always names the same creative; ``term`` uses ``utm_term`` for paid sources only and
    takes video sites for engines. ``trackers`` has ``source``, ``android`` and ``ios``; of a source
    that it repeats the last row by ``order`` counts, see ``one_per_key``. ``base_url`` ends with a slash.
    """
    source = touch_source_legacy(F.col("url"), F.col("referrer"), "qr_video" if variant == "term" else "qr")

    def param(name: str) -> Column:
        return F.coalesce(url_param(F.col("url"), name, "decoded"), F.lit("undefined"))

    own = F.concat(F.lit("campaign="), F.col("url"), F.lit("&adgroup="), F.coalesce("referrer", F.lit("")))
    paid = F.concat(F.lit("campaign="), param("utm_campaign"), F.lit("&adgroup="), param("utm_content"))
    if variant == "constant":
        own, paid = (F.concat(link, F.lit(f"&creative={creative}")) for link in (own, paid))
    else:
        paid = F.concat(paid, F.lit("&creative="), param("utm_term"))
    known = one_per_key(trackers.select("source", "android", "ios", *([order] if order else [])), "source", order)
    ids = known.select("source", F.concat_ws("_", "android", "ios").alias("_ids"))
    return (
        touches.withColumn("source", source)
        .join(ids, "source", "left")
        .withColumn(
            "tracker_url",
            F.concat(
                F.lit(base_url),
                F.coalesce("_ids", F.lit("undefined")),
                F.lit("?"),
                F.when(F.col("source").isin(OWN_PAGE_SOURCES), own).otherwise(paid),
            ),
        )
        .drop("_ids")
    )


def sticky_tracker(touches: DataFrame, default_url: str) -> DataFrame:
    """First tracker URL of every user, or the default link for users without one."""
    first = first_over(touches, ["user_id"], "tracker_url", TOUCH_ORDER)
    return first.withColumn("tracker_url", F.coalesce("tracker_url", F.lit(default_url)))


# Click ids kept with a page record.
CLICK_IDS = ["awc", "gclid", "gbraid", "fbclid", "fbc", "fbp"]


def page_event_columns() -> list[Column]:
    """Path, click ids and marketing source of a touch."""
    url = F.col("url")
    return [
        url_path(url).alias("name"),
        *[url_param(url, click_id, "search_params").alias(click_id) for click_id in CLICK_IDS],
        touch_source(url, F.col("referrer"), "page_event").alias("marketing_source"),
    ]


def page_event(touches: DataFrame) -> DataFrame:
    """Page record of every touch."""
    return touches.select("event_id", "user_id", "ts", *page_event_columns())


# Constant fields of a conversion.
CONVERSION = {
    "amount": "1",
    "channel": "aw",
    "parts": "Default:1",
    "currency": "EUR",
    "voucher": "null",
    "test": "1",
}


def affiliate_conversions(
    touches: DataFrame, mode: str = "tag", pixel_base: str | None = None, merchant: str = "0"
) -> DataFrame:
    """Conversion record of every touch, with the user as order reference.

    ``tag`` reads the parameters from the URL. ``stored`` has been through text storage, where a
    missing value became the text ``undefined``. ``pixel`` adds the image URL of the stored form, on
    the network's ``pixel_base``.
    """
    if mode == "pixel" and not pixel_base:
        raise ValueError("a pixel needs pixel_base")

    def param(name: str) -> Column:
        value = url_param(F.col("url"), name, "decoded", bare="true")
        return value if mode == "tag" else F.coalesce(value, F.lit("undefined"))

    custom = {"source": "utm_source", "medium": "utm_medium", "campaign": "utm_campaign", "awc_param": "awc"}
    out = touches.select(
        "event_id",
        F.col("user_id").alias("order_ref"),
        *[F.lit(value).alias(name) for name, value in CONVERSION.items()],
        *[param(name).alias(alias) for alias, name in custom.items()],
    )
    if mode != "pixel":
        return out
    head = f"{pixel_base}?tt=ss&tv=2&merchant={merchant}&amount=1&ch=aw&parts=DEFAULT:1&ref="
    return out.withColumn(
        "pixel_url",
        F.concat(
            F.lit(head),
            F.coalesce("order_ref", F.lit("null")),
            F.lit("&vc=0&cr=EUR&testmode=1&cks="),
            F.col("awc_param"),
        ),
    )
