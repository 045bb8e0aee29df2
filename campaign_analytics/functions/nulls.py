"""Null rules shared by the jobs, so that each is decided in one place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matches(col: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Regex test that is false, not null, for a missing value."""
    return F.coalesce(col.rlike(f"(?i){pattern}" if ignore_case else pattern), F.lit(False))


def equals(col: Column, value: str) -> Column:
    """Equality that is false, not null, for a missing value."""
    return F.coalesce(col == value, F.lit(False))


def sum_or_zero(col: Column) -> Column:
    """Sum that is 0 for a group holding only nulls."""
    return F.coalesce(F.sum(col), F.lit(0))


def money_sum(col: Column, scale: int = 12) -> Column:
    """Sum money as a decimal of ``scale`` places and return a double; costs in millionths keep their digits.

    Decimal addition does not depend on the order of rows, so re-run tasks give the same digits.
    """
    return F.coalesce(F.sum(col.cast(f"decimal(28,{scale})")), F.lit(0)).cast("double")


def drop_null_dims(df: DataFrame, dims: list[str]) -> DataFrame:
    """Rows with a null in any grouping column do not form a group."""
    return df.dropna(subset=dims)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
