"""Deep links, tagged URLs, app links and the link log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import device_type, form_component, uri_component, url_param
from ..operators.joins import default_campaign, one_per_key, tracker_lookup

# Link types that take a category or course, and the two rejection messages.
DETAIL_LINKS = ["Short term job offers with category", "LMS links"]
NO_TRACKER = "Cannot create link: Please select valid platform and channel"
NO_LINK = "Cannot create link: Please select deeplink type"


def deep_links(
    requests: DataFrame,
    trackers: DataFrame,
    links: DataFrame,
    defaults: DataFrame,
    base_link: str = "https://exampleurl",
    order: dict[str, str] | None = None,
) -> DataFrame:
    """Full deep link of every request, or the reason there is none.

    A request needs a known tracker and a chosen link. Category and course links carry the
    request's detail at the end of both the path and the app address. App address and fallback
    are percent-encoded, campaign fields are passed on as they are.

    ``order`` names the order column of the tables ``trackers``, ``links`` and ``defaults`` that may repeat a name: the
    last row counts. A name with different rows in a table without one is an error, see ``one_per_key``.
    """
    by = order or {}
    columns = ["name", "urlScheme", "deeplinkExample", *([by["links"]] if "links" in by else [])]
    known = one_per_key(links.select(*columns), "name", by.get("links"))
    known = known.select(F.col("name").alias("deeplink"), "urlScheme", "deeplinkExample")
    tracked = tracker_lookup(requests, trackers, by.get("trackers"))
    rows = default_campaign(tracked, defaults, by.get("defaults")).join(known, "deeplink", "left")
    detail = F.when(F.col("deeplink").isin(DETAIL_LINKS), F.coalesce("additional_detail", F.lit(""))).otherwise("")
    fallback = uri_component(F.coalesce("fallback_url", F.lit("")))
    parts = [
        ("adj_t", F.concat_ws("_", "android_id", "ios_id")),
        ("adj_deep_link", uri_component(F.concat("deeplinkExample", detail))),
        ("adj_campaign", F.col("campaign")),
        ("adj_adgroup", F.col("adgroup")),
        ("adj_creative", F.col("creative")),
        ("adj_fallback", fallback),
        ("adj_redirect_macos", fallback),
    ]
    query = F.concat_ws("&", *[F.concat(F.lit(f"{name}="), value) for name, value in parts])
    error = F.when(F.col("android_id").isNull() | F.col("ios_id").isNull(), F.lit(NO_TRACKER)).when(
        (F.coalesce("deeplink", F.lit("")) == "") | F.col("urlScheme").isNull(), F.lit(NO_LINK)
    )
    link = F.concat(F.lit(base_link), F.col("urlScheme"), detail, F.lit("?"), query)
    return rows.withColumn("error", error).withColumn("link", F.when(F.col("error").isNull(), link))


def utm_url(base: Column, campaign: Column, medium: Column, source: Column, content: Column, term: Column) -> Column:
    """Base URL with the non-empty UTM values, form-encoded, in this order."""
    values = {"campaign": campaign, "medium": medium, "source": source, "content": content, "term": term}
    pairs = [
        F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"utm_{name}="), form_component(value)))
        for name, value in values.items()
    ]
    query = F.concat_ws("&", *pairs)
    separator = F.when(F.instr(base, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    return F.when(query == "", base).otherwise(F.concat(base, separator, query))


def app_link(url: Column, base_url: str, campaign_suffix: str) -> Column:
    """Store link carrying the page's campaign; a missing parameter is the text ``undefined``."""

    def param(name: str) -> Column:
        return F.coalesce(url_param(url, name, "decoded", bare="true"), F.lit("undefined"))

    return F.concat(
        F.lit(f"{base_url}?campaign="),
        param("utm_campaign"),
        F.lit(f"{campaign_suffix}&adgroup="),
        param("utm_content"),
        F.lit("&creative="),
        param("utm_term"),
    )


def app_links(job_views: DataFrame, base_url: str, campaign_suffix: str) -> DataFrame:
    """Device of every job view with its store link, or its QR link on a desktop.

    ``campaign_suffix`` marks the links of these pages behind their campaign.
    """
    device = device_type(F.col("user_agent"))
    desktop = app_link(F.col("url"), base_url, f"{campaign_suffix}_QR_code")
    mobile = app_link(F.col("url"), base_url, campaign_suffix)
    return job_views.withColumn("device", device).withColumn(
        "app_link", F.when(F.col("device") == "desktop", desktop).otherwise(mobile)
    )
