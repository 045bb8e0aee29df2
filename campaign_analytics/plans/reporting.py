"""The daily channel report and the report on contacts placing orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compact_date, rolling_range
from ..functions.nulls import drop_null_dims
from ..functions.text import contains_any, contains_ci
from ..operators.aggregates import event_counts, organic_daily, pageviews_by_origin, paid_daily, unique_by
from ..operators.filters import campaign_condition, dims_first, drop_cols, rename_with, web_origin
from ..operators.sets import stack
from ..sources.reports import scan_between

REPORT_DIMS = ["date_dt", "eventName", "web_origin_type"]


def report_events(events: DataFrame, text: str = "b2b") -> DataFrame:
    """Event report rows whose event name contains ``text``, with real dates."""
    return rename_with(
        events.where(contains_ci(F.col("eventName"), text)).withColumn("date", compact_date(F.col("date"))),
        {"date": "date_dt"},
    )


def report_pages(pages: DataFrame, site_pages: list[str]) -> DataFrame:
    """Page report rows of the listed site pages, classified as organic or paid."""
    listed = pages.where(contains_any(F.col("pagePath"), site_pages))
    return rename_with(
        listed.withColumn("date", compact_date(F.col("date"))).withColumn(
            "web_origin_type", web_origin(F.col("sessionSourceMedium"))
        ),
        {"date": "date_dt"},
    )


def report_costs(
    costs: DataFrame, start: str, end: str, include: list[str], exclude: list[str], exclude_mode: str = "any"
) -> DataFrame:
    """Cost rows of the wanted campaigns in a range of days.

    The campaign list is a function of the name alone, so it is applied to the rows directly
    instead of first collecting names and joining them back.
    """
    wanted = campaign_condition(F.col("campaign"), include, exclude, exclude_mode)
    return drop_cols(scan_between(costs, "date_dt", start, end).where(wanted), ["cpc"])


def report_organic(organic: DataFrame, start: str, end: str, site_pages: list[str]) -> DataFrame:
    """Organic search rows of the listed site pages in a range of days; case matters here."""
    listed = scan_between(organic, "date", start, end).where(
        contains_any(F.col("page"), site_pages, ignore_case=False)
    )
    return rename_with(listed, {"date": "date_dt"})


def basis_report(
    events: DataFrame,
    organic: DataFrame,
    costs: DataFrame,
    pages: DataFrame,
    start: str,
    end: str,
    include: list[str],
    exclude: list[str],
    site_pages: list[str],
    event_text: str = "b2b",
    exclude_mode: str = "any",
) -> DataFrame:
    """Daily events, organic search, paid campaigns and page views stacked into one table.

    Every block is reduced to days before the union; columns a block lacks stay null.
    """
    blocks = [
        event_counts(report_events(events, event_text)),
        organic_daily(report_organic(organic, start, end, site_pages)),
        paid_daily(report_costs(costs, start, end, include, exclude, exclude_mode)),
        pageviews_by_origin(report_pages(pages, site_pages)),
    ]
    return dims_first(stack(blocks), REPORT_DIMS)


CONTACT_FIELDS = ["first_name", "last_name", "email", "company_name", "industry_category_summarized_name"]
ORDER_METRICS = ["company_order_id", "company_order_shift_id"]


def _order_shifts(t: dict[str, DataFrame], start, end) -> DataFrame:
    """Order shifts of a range of order days by the id of their contact, with the name of their region.

    Filtered orders meet the order-shift fact first; the dimensions follow and are small enough
    for Spark to broadcast by their size.
    """
    orders = scan_between(t["company_order"], "created_dt", start, end).select(
        F.col("id").alias("company_order_id"), F.col("created_by_id").alias("company_user_id"), F.col("created_dt").alias("order_created_dt")
    )
    shifts = t["company_order_shift"].select(
        "company_order_shift_id", F.col("company_order_id").alias("_order"), "job_category_id", "job_location_id"
    )
    return (
        orders.join(shifts, F.col("company_order_id") == F.col("_order"))
        .join(t["job_category"].select("job_category_id"), "job_category_id")
        .join(t["job_location"].select("job_location_id", "business_region_id"), "job_location_id")
        .join(t["business_region"].select("business_region_id", "business_region_name"), "business_region_id")
        .select("company_user_id", "business_region_name", "order_created_dt", *ORDER_METRICS)
    )


def _contacts(t: dict[str, DataFrame]) -> DataFrame:
    """Contacts by id with their names, company and industry."""
    users = t["company_user"].select(
        F.col("id").alias("company_user_id"), "first_name", "last_name", "email", F.col("company_id").alias("_company")
    )
    companies = t["company"].select(
        "company_id", F.col("name").alias("company_name"), F.col("industry_subcategory_id").alias("_industry")
    )
    industries = t["industry_subcategory"].select("industry_subcategory_id", "industry_category_summarized_name")
    return (
        users.join(companies, F.col("_company") == F.col("company_id"))
        .join(industries, F.col("_industry") == F.col("industry_subcategory_id"))
        .select("company_user_id", *CONTACT_FIELDS)
    )


def company_orders(t: dict[str, DataFrame], start, end) -> DataFrame:
    """Order shifts of a range of order days with contact, company, industry and region."""
    return _order_shifts(t, start, end).join(_contacts(t), "company_user_id").select(
        "company_user_id", *CONTACT_FIELDS, "business_region_name", "order_created_dt", *ORDER_METRICS
    )


def contacts_placing_orders(t: dict[str, DataFrame], as_of: str, days: int = 90) -> DataFrame:
    """Contacts with their distinct orders and order shifts of the last ``days`` days.

    Orders are counted by the contact's id; names and addresses are attached to the counts, so that no text but the
    region's name is shuffled with the facts. A contact without one of them is left out.
    """
    dims = ["company_user_id", "business_region_name", "order_created_dt"]
    counts = unique_by(_order_shifts(t, *rolling_range(as_of, days, 1)), dims, ORDER_METRICS)
    contacts = drop_null_dims(_contacts(t).distinct(), CONTACT_FIELDS)
    numbers = [c for c in counts.columns if c not in dims]
    return counts.join(contacts, "company_user_id").select(
        "company_user_id", *CONTACT_FIELDS, "business_region_name", "order_created_dt", *numbers
    )
