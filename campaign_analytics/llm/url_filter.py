"""Judge URLs by host and path rules and by a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, carried, might_hold

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Query parameters that say where a visit came from and not what the page is.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    text = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    rest = F.regexp_extract(text, r"^(?s:.*?)://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(text, r"^(?s:.*?)://([^/?#]*)([^?#]*)", 2)
    return F.translate(rest, ASCII_UPPER, ASCII_LOWER), path


def canonical_url(url: str) -> Column:
    """One spelling per page: host without www. or m., no trailing slash, no fragment, parameters in order and
    without tracking ones. Null without a host.
    """
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    plain = F.concat(
        F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"/+$", ""), F.lit("?"), F.array_join(kept, "&")
    )
    return F.when(host != "", F.regexp_replace(plain, r"\?$", ""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule (verdict, host, path prefix) that fits, or null.

    The rules are an argument of a few hundred at most; long lists belong in the table of canonical URLs.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """Every row of ``pages`` with host, path, canonical, listed, rule and verdict added.

    ``listed`` has a column canonical. Its Bloom filter, of bounded size, is broadcast; only rows that it lets
    pass meet the list itself in an exact join, which takes the false hits out again. A fitting rule decides
    the verdict, else a listed URL is blocked and any other allowed.

    Null URLs and those without ``://`` have an empty host and path, are never listed and are allowed unless a
    rule fits. Repeated rows are judged one by one; repeats and nulls in the list do not matter. Empty tables
    are fine. Input columns with the names of added ones are replaced.
    """
    return carried(pages, [url], lambda rows: _judged(rows, listed, rules, url))


def _judged(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], url: str) -> DataFrame:
    host, path = host_and_path(url)
    made = {"host": host, "path": path, "canonical": canonical_url(url)}
    base = pages.withColumns(made)
    keys = listed.select("canonical").filter("canonical is not null").distinct()
    base = might_hold(base, "canonical", bloom_filter(keys, "canonical"), "_maybe")
    hit = keys.withColumn("listed", F.lit(True))
    possible = base.filter("_maybe").join(hit, "canonical", "left")
    possible = possible.withColumn("listed", F.coalesce("listed", F.lit(False)))
    judged = base.filter("not _maybe").withColumn("listed", F.lit(False)).unionByName(possible).drop("_maybe")
    judged = judged.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
    otherwise = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    judged = judged.withColumns({"rule": F.col("_fit.rule"), "verdict": F.coalesce(F.col("_fit.verdict"), otherwise)})
    return judged.drop("_fit")
