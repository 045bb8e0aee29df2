"""Lead form validation and lead records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_utc
from ..functions.text import trimmed, valid_email
from ..functions.urls import url_param

# Required fields, choice fields with their placeholder, and messages in order.
REQUIRED = ["first_name", "last_name", "email", "phone", "company", "zip", "industry", "callback", "bedarf__c"]
CHOICES = ["industry", "callback"]
PLACEHOLDER = "Bitte auswählen"
EMPTY_FIELD = "Bitte füllen Sie alle Felder aus."
BAD_EMAIL = "Bitte hinterlegen Sie eine gültige Email-Adresse."
BAD_ZIP = "Bitte hinterlegen Sie eine gültige Postleitzahl."
URL_FIELDS = ["utm_source", "utm_medium", "utm_content", "utm_campaign", "utm_term", "gclid"]


def validate_leads(leads: DataFrame, profile: str = "full") -> DataFrame:
    """Failed checks of every lead, the message shown first, and whether it is accepted.

    ``full`` needs all nine fields, a well-formed e-mail and a zip of at most five characters.
    ``short`` checks nothing but the e-mail.
    """

    def empty(name: str) -> Column:
        blank = trimmed(F.col(name)) == ""
        return blank | (trimmed(F.col(name)) == PLACEHOLDER) if name in CHOICES else blank

    email = F.when(~valid_email(trimmed(F.col("email"))), F.lit(BAD_EMAIL))
    if profile == "short":
        fields, checks = F.array().cast("array<string>"), [email]
    elif profile == "full":
        fields = F.array_compact(F.array(*[F.when(empty(name), F.lit(name)) for name in REQUIRED]))
        checks = [
            F.when(F.size("empty_fields") > 0, F.lit(EMPTY_FIELD)),
            email,
            F.when(F.length(F.coalesce("zip", F.lit(""))) > 5, F.lit(BAD_ZIP)),
        ]
    else:
        raise ValueError(f"unknown profile {profile!r}")
    return (
        leads.withColumn("empty_fields", fields)
        .withColumn("errors", F.array_compact(F.array(*checks)))
        .withColumn("first_error", F.get("errors", F.lit(0)))
        .withColumn("accepted", F.col("first_error").isNull())
    )


def lead_records(leads: DataFrame, form_tag: str, submitted_at: str = "ts") -> DataFrame:
    """Leads with the campaign fields of their page, the form's tag and the submit time."""
    return leads.withColumns(
        {
            **{name: url_param(F.col("page_url"), name, "form") for name in URL_FIELDS},
            "utm_adgroup": F.lit(form_tag),
            "datetime": iso_utc(F.col(submitted_at)),
        }
    )
