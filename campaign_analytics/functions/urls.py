"""URL and referrer columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import any_of

# Referrers counted as search engines, and the longer list of one page variant.
SEARCH_ENGINES = [
    "https://www.google.com/",
    "https://www.google.de/",
    "https://www.bing.com/",
    "https://www.ecosia.org/",
    "https://search.yahoo.com/",
    "https://duckduckgo.com/",
]
SEARCH_AND_VIDEO = SEARCH_ENGINES + ["https://www.youtube.com/", "https://www.youtube.de/"]


def query_string(url: Column) -> Column:
    """Text between the first ``?`` and the fragment; empty when there is none."""
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def url_path(url: Column) -> Column:
    """Path of an absolute URL; ``/`` when it is empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(url.isNull(), None).when(path == "", F.lit("/")).otherwise(path)


def percent_decode(text: Column) -> Column:
    """Percent decoding that leaves ``+`` alone; null when the escapes are malformed."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def form_decode(text: Column) -> Column:
    """Percent decoding that also reads ``+`` as a blank; null when malformed."""
    return F.try_url_decode(text)


def url_param(url: Column, name: str, style: str = "nullable", bare: str = "Unknown") -> Column:
    """First value of a query parameter, under one of four reading rules.

    ``decoded``   decode the query, then split on ``&`` and ``=``: missing is null and a key
                  without ``=`` gives ``bare``
    ``form``      only ``name=value`` counts; ``+`` is a blank; missing is ``''``
    ``nullable``  missing is null, a bare key is ``''``; ``+`` is a blank
    ``search_params``  as ``nullable``, but read from the query alone, never from the fragment; a
                  malformed escape stays as it is
    """
    key = re.escape(name)
    rest_of_text = 1 << 30
    if style == "decoded":
        # One search finds "&name" or "&name=value"; a name without "=" then gets the bare value.
        text = F.concat(F.lit("&"), percent_decode(query_string(url)))
        hit = F.regexp_substr(text, F.lit(rf"&{key}(?:=[^=&]*)?(?=[=&]|\z)"))
        tail = F.regexp_replace(F.substring(hit, len(name) + 2, rest_of_text), r"^\z", f"={bare}")
        return F.substring(tail, 2, rest_of_text)
    if style == "form":
        query = F.concat(F.lit("?"), query_string(url))
        value = F.regexp_extract(query, rf"[?&]{key}=([^&#]*)", 1)
        return F.coalesce(form_decode(value), F.lit(""))
    if style == "nullable":
        hit = F.regexp_substr(url, F.lit(rf"[?&]{key}(?:=[^&#]*)?(?=[&#]|\z)"))
        return form_decode(F.substring(hit, len(name) + 3, rest_of_text))
    if style == "search_params":
        pairs = F.concat(F.lit("&"), query_string(url))
        hit = F.regexp_substr(pairs, F.lit(rf"&{key}(?:=[^&]*)?(?=&|\z)"))
        value = F.substring(hit, len(name) + 3, rest_of_text)
        return form_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))
    raise ValueError(f"unknown style {style!r}")


def host_label(referrer: Column) -> Column:
    """Text before the first dot, without scheme and ``www.``; null when there is no dot."""
    label = F.regexp_extract(referrer, r"(?:https?://)?(?:www\.)?(.*?)\.", 1)
    return F.when(F.instr(referrer, ".") > 0, label)


def append_param(url: Column, key: str, value: Column) -> Column:
    """Add ``key=value`` unless the URL already has ``key=`` or there is no value."""
    separator = F.when(F.instr(url, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    return F.when(
        (F.coalesce(value, F.lit("")) == "") | (F.instr(url, f"{key}=") > 0), url
    ).otherwise(F.concat(url, separator, F.lit(f"{key}="), value))


def device_type(user_agent: Column) -> Column:
    agent = F.coalesce(user_agent, F.lit(""))
    return (
        F.when(agent.rlike("(?i)Android"), F.lit("android"))
        .when(agent.rlike("(?i)iPhone|iPad|iPod"), F.lit("ios"))
        .otherwise(F.lit("desktop"))
    )


def starts_with_any(referrer: Column, prefixes: list[str] = SEARCH_ENGINES) -> Column:
    ref = F.coalesce(referrer, F.lit(""))
    return any_of([ref.startswith(prefix) for prefix in prefixes])


def equals_any(referrer: Column, values: list[str] = SEARCH_ENGINES) -> Column:
    return F.coalesce(referrer, F.lit("")).isin(values)


def uri_component(text: Column) -> Column:
    """Percent-encode all but letters, digits and ``- _ . ! ~ * ' ( )``."""
    out = F.url_encode(text)
    for encoded, plain in [
        ("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~"),
    ]:
        out = F.replace(out, F.lit(encoded), F.lit(plain))
    return out


def form_component(text: Column) -> Column:
    """Like ``uri_component`` with blanks as ``+``."""
    return F.replace(uri_component(text), F.lit("%20"), F.lit("+"))
