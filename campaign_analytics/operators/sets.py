"""Unions, distinct values, top rows and pages."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import order_key


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union of frames with different columns; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def head(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """First ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)


# Rows sorted together for one page at most, and ranges counted at a time on the way to them.
PAGE_ROWS, RANGES = 50_000, 4096


class _Stretch(NamedTuple):
    """The rows with ``low <= at <= high``: how many there are, and how many come before them."""

    low: int
    high: int
    above: int
    n: int


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def _within(df: DataFrame, at: Column, part: _Stretch) -> DataFrame:
    return df.where(at.between(_whole(part.low), _whole(part.high)))


def _stretch_of(df: DataFrame, at: Column, rank: int, part: _Stretch, rows: int) -> _Stretch:
    """At most ``rows`` rows, or rows of one value, around the row with a descending rank, counted from 0.

    Each round counts rows in ``RANGES`` ranges of values and goes on in the one that holds the rank. Only these
    counts reach the driver.
    """
    while part.n > rows and part.low < part.high:
        width = -(-(part.high - part.low + 1) // RANGES)
        slot = F.call_function("div", at - _whole(part.low), _whole(width)).alias("slot")
        above = part.above
        for number, n in sorted(_within(df, at, part).groupBy(slot).count().collect(), reverse=True):
            if rank < above + n:
                low = part.low + number * width
                part = _Stretch(low, min(part.high, low + width - 1), above, n)
                break
            above += n
    return part


def _ranked(df: DataFrame, at: Column, first: int, last: int, part: _Stretch, rows: int) -> DataFrame:
    """The rows with ranks ``first`` to ``last`` of a stretch, as far as it goes; equal rows by a hash of the row."""
    first, last = max(first, part.above), min(last, part.above + part.n - 1)
    tie = F.xxhash64(*df.columns)
    found = _within(df, at, part)
    if part.n <= rows:
        return found.orderBy(at.desc(), tie.desc()).offset(first - part.above).limit(last - first + 1)
    marked = found.withColumn("_tie", tie)
    spread = order_key(marked, "_tie")
    whole = _Stretch(0, 2**64, part.above, part.n)
    top = _stretch_of(marked, spread, first, whole, rows)
    bottom = _stretch_of(marked, spread, last, whole, rows)
    some = _within(marked, spread, _Stretch(bottom.low, top.high, 0, 0))
    return some.orderBy(F.col("_tie").desc()).offset(first - top.above).limit(last - first + 1).drop("_tie")


def page_of(df: DataFrame, order: str, page: int, size: int = 10, rows: int = PAGE_ROWS) -> DataFrame:
    """One page, newest first, with the total row count and the number of pages.

    The stretches of values that hold the page's first and last row are found by counting rows per range of the order
    column, until at most ``rows`` rows or one value are left in each. Only these are sorted, so the last page of a
    large log costs as much as its first. Rows of equal order are in the order of a hash of the row, so that every row
    is on one page. A page past the end has no rows. ``order`` is a whole number, a date or a time stamp; nulls come last.
    """
    at = order_key(df, order)
    known = df.agg(F.count("*").alias("n"), F.min(at).alias("low"), F.max(at).alias("high")).first()
    first = size * (page - 1)
    last = min(first + size, known.n) - 1
    numbers = [
        F.lit(known.n).cast("bigint").alias("length"),
        F.lit(-(-known.n // size)).cast("bigint").alias("total_pages"),
        F.lit(page).alias("page"),
    ]
    if page < 1 or first > last:
        return df.limit(0).select("*", *numbers)
    whole = _Stretch(int(known.low), int(known.high), 0, known.n)
    top = _stretch_of(df, at, first, whole, rows)
    parts = [_ranked(df, at, first, last, top, rows)]
    if last >= top.above + top.n:
        bottom = _stretch_of(df, at, last, whole, rows)
        parts.append(df.where((at < _whole(top.low)) & (at > _whole(bottom.high))))  # fewer than a page
        parts.append(_ranked(df, at, first, last, bottom, rows))
    found = parts[0] if len(parts) == 1 else union_all(parts).orderBy(at.desc(), F.xxhash64(*df.columns).desc())
    return found.select("*", *numbers)
