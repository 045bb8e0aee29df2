"""Text columns: validation, formatting, wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import any_of

# Fixed value: accepted shape of an e-mail address.
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+\z"


def trimmed(col: Column) -> Column:
    """Strip all white space at both ends; null becomes empty."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"^\s+|\s+\z", "")


def valid_email(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).rlike(EMAIL_PATTERN)


def trim_len_ok(col: Column, limit: int = 255) -> Column:
    """True when the trimmed text has between 1 and ``limit`` characters."""
    return F.length(trimmed(col)).between(1, limit)


def contains_ci(col: Column, text: str) -> Column:
    """Case-insensitive contains; false for a missing value."""
    return F.coalesce(F.upper(col).contains(text.upper()), F.lit(False))


def contains_any(col: Column, texts: list[str], ignore_case: bool = True) -> Column:
    if ignore_case:
        return any_of([contains_ci(col, text) for text in texts])
    return any_of([F.coalesce(col.contains(text), F.lit(False)) for text in texts])


def sql_escape(col: Column) -> Column:
    """Double every single quote."""
    return F.replace(col, F.lit("'"), F.lit("''"))


def pct_text(rate: Column) -> Column:
    """Percent with two decimals, null for an undefined rate.

    The rate is rounded as a decimal first, so the text does not depend on binary ties.
    """
    return F.concat((rate * 100).cast("decimal(20,2)").cast("string"), F.lit("%"))


def join_list(col: Column, separator: str = ", ") -> Column:
    return F.array_join(col, separator)


def join_pairs(col: Column, key: str, value: str, separator: str = "; ") -> Column:
    """``key: value`` of every struct in an array, joined."""
    return F.array_join(
        F.transform(col, lambda x: F.concat(x[key], F.lit(": "), x[value])), separator
    )


def greeting(first_name: Column) -> Column:
    return F.when(trimmed(first_name) == "", F.lit("Hey,")).otherwise(
        F.concat(F.lit("Hey "), first_name, F.lit(","))
    )


def localized(language: Column, german: Column, other: Column) -> Column:
    return F.when(language == "de", german).otherwise(other)


def truthy(col: Column) -> Column:
    return F.coalesce(col == "true", F.lit(False))


def rating_event(rating: Column) -> Column:
    """Event name of an app rating; none for a rating of 0 or less."""
    return F.when(rating > 0, F.concat(F.lit("UserRatedApp"), rating.cast("string")))


def rating_of(event_name: Column) -> Column:
    """Rating held in an event name, null for other events."""
    digits = F.regexp_extract(event_name, r"^UserRatedApp([0-9]+)\z", 1)
    return F.when(digits != "", digits.cast("int"))
