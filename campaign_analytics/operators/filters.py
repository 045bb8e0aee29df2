"""Column selection and row predicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.nulls import all_of, any_of


def drop_cols(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def dims_first(df: DataFrame, dims: list[str]) -> DataFrame:
    """Dimensions at the front, every other column after them in its old order."""
    return df.select(*dims, *[c for c in df.columns if c not in dims])


def rename_with(df: DataFrame, rule: Callable[[str], str] | dict[str, str]) -> DataFrame:
    """Rename by a dict, or by a function of the old name."""
    names = rule if isinstance(rule, dict) else {c: rule(c) for c in df.columns}
    return df.withColumnsRenamed(names)


def campaign_condition(
    col: Column, include: list[str], exclude: list[str], exclude_mode: str = "any"
) -> Column:
    """Any include pattern matches and the excludes do not, ignoring case.

    ``exclude_mode='any'`` keeps a name that avoids at least one exclude pattern, which is how the
    report has always been defined; ``'all'`` keeps only names avoiding every one of them.
    """
    combine = {"any": any_of, "all": all_of}[exclude_mode]
    wanted = any_of([col.ilike(f"%{text}%") for text in include])
    if not exclude:
        return wanted
    return wanted & combine([~col.ilike(f"%{text}%") for text in exclude])


def campaign_filter(
    df: DataFrame,
    include: list[str],
    exclude: list[str],
    exclude_mode: str = "any",
    col: str = "campaign",
) -> DataFrame:
    """Distinct campaign names passing ``campaign_condition``."""
    return df.where(campaign_condition(F.col(col), include, exclude, exclude_mode)).select(col).distinct()


def in_list(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows whose value occurs in ``keys``."""
    wanted = keys.select(F.col(key_col or col).alias(col))
    return df.join(wanted, col, "left_semi")


def snapshot(df: DataFrame, as_of: str, date_col: str = "date_dt") -> DataFrame:
    return df.where(F.col(date_col) == as_date(as_of))


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def positive_only(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) > 0)


def live_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "LIVE")


def choose_preference(worked: Column, applied: Column, seen: Column, eligible: Column) -> Column:
    """Pick a category by evidence: applied, else worked, else seen, else eligible."""
    return (
        F.when(worked == applied, worked)
        .when(applied.isNotNull(), applied)
        .when(worked.isNotNull(), worked)
        .when(seen.isNotNull(), seen)
        .otherwise(eligible)
    )


def web_origin(source_medium: Column) -> Column:
    """``Organic`` for a direct source or an organic medium, else ``Paid``.

    ``(not set)`` stands for an unset source and an unset medium, and is therefore paid.
    """
    parts = F.split(source_medium, " / ")
    organic = (F.get(parts, F.lit(0)) == "(direct)") | (F.get(parts, F.lit(1)) == "organic")
    return F.when(F.coalesce(organic, F.lit(False)), F.lit("Organic")).otherwise(F.lit("Paid"))
