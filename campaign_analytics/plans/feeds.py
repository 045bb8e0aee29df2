"""The job feed, single job views, board listings and bonus programs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_list, join_pairs, localized
from ..operators.filters import live_only
from ..operators.joins import row_by_id

# Legal notes put behind every description, in both languages.
NOTE_DE = (
    "Eine Bewerbung ist nur über unsere App möglich. Aufgrund von gesetzlichen Vorgaben und technischen "
    "Besonderheiten unseres digitalen Geschäftsmodells, ist eine Bewerbung derzeit nur für Studierende sowie "
    "Menschen mit einer sozialversicherungspflichtigen Hauptbeschäftigung möglich."
)
NOTE_EN = (
    "An application is only possible via our app. Due to legal requirements and technical peculiarities of our "
    "digital business model, an application is currently only possible for students and people with a main "
    "employment subject to social security contributions."
)
COUNTRY = "Deutschland"
FEED_FIELDS = ["referencenumber", "title", "date", "city", "salary", "url", "jobtype", "language", "category"]
VIEW_FIELDS = ["title", "referencenumber", "city", "salary", "jobtype", "language"]

# Section headings of a board listing (German, other).
HEADINGS = {
    "offer": ("<h4>Deine Vorteile bei uns</h4>", "<h4>Your benefits with us</h4>"),
    "tasks": ("<h4>Deine Aufgaben</h4>", "<h4>Your tasks</h4>"),
    "profile": ("<h4>Das brauchen wir von dir</h4>", "<h4>Your profile</h4>"),
    "contactinfo": ("<h4>Wie geht es weiter</h4>", "<h4>What are the next steps?</h4>"),
}


def job_feed(jobs: DataFrame, company: str, source_name: str | None = None) -> DataFrame:
    """Live jobs in feed order. The bulk feed always carries the German note."""
    note = F.lit(f"<div><br><em>{NOTE_DE}</em></div>")
    return live_only(jobs).select(
        *FEED_FIELDS,
        F.concat(F.coalesce("description", F.lit("")), note).alias("description"),
        F.lit(COUNTRY).alias("country"),
        F.lit(company).alias("company"),
        F.lit(source_name or company).alias("sourcename"),
    )


def resolve_views(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """The feed row that each request for a single job is about: its columns and ``row_no``, null where there is none.

    With a digit in ``dav`` that text is the row number, else the last row with the job id counts. Only ids and row
    numbers are read of the feed.
    """
    specific = requests.where(F.coalesce("job_id", F.lit("")) != "")
    by_number = F.coalesce("dav", F.lit("")).rlike("[0-9]")
    number = F.expr("try_cast(dav AS bigint)")
    numbered = specific.where(by_number).withColumn("row_no", F.when(number.cast("string") == F.col("dav"), number))
    last = jobs.where("referencenumber IS NOT NULL").groupBy(F.col("referencenumber").alias("_id"))
    last = last.agg(F.max("row_no").cast("bigint").alias("row_no"))
    named = specific.where(~by_number).join(last, F.col("job_id") == F.col("_id"), "left").drop("_id")
    return numbered.unionByName(named)


def job_view(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """What each page request gets to see.

    ``requests`` has ``request_id``, ``job_id`` and ``dav``, the feed unique row numbers. Without a job id the whole
    feed is served (``generic``); these requests meet no job. The others are resolved to a row number first, see
    ``resolve_views``, and then the feed's texts are joined once. Rows that are missing or not live give
    ``jobNotFound`` or ``jobInactive``.
    """
    wanted = resolve_views(jobs, requests.select("request_id", "job_id", "dav"))
    # A request without a row keeps a key that no row has, spread over many values.
    spread = F.when(F.col("row_no").isNull(), 1 + F.pmod(F.xxhash64("request_id"), F.lit(1024))).otherwise(F.lit(0))
    keyed = wanted.select("request_id", F.coalesce("row_no", F.lit(0)).alias("_row"), spread.cast("bigint").alias("_none"))
    fields = jobs.where("row_no IS NOT NULL").select(
        F.col("row_no").cast("bigint").alias("_row"),
        F.lit(0).cast("bigint").alias("_none"),
        F.lit(True).alias("_found"),
        "status",
        *VIEW_FIELDS,
        F.col("description").alias("_text"),
    )
    result = (
        F.when(F.col("_found").isNull(), F.lit("jobNotFound"))
        .when(F.col("status") == "LIVE", F.lit("ok"))
        .otherwise(F.lit("jobInactive"))
    )
    ok = F.col("result") == "ok"
    note = localized(F.when(F.col("language") == "en", F.lit("en")).otherwise("de"), F.lit(NOTE_DE), F.lit(NOTE_EN))
    description = F.concat(
        F.coalesce("_text", F.lit("")),
        F.lit("<div id='hiddenPara'><br><em>"),
        note,
        F.lit("</em></div>"),
    )
    # The description is made from the job's own language, before the fields of other results are emptied.
    shown = (
        keyed.join(fields, ["_row", "_none"], "left")
        .withColumn("result", result)
        .withColumn("description", F.when(ok, description))
        .select("request_id", "result", *[F.when(ok, F.col(c)).alias(c) for c in VIEW_FIELDS], "description")
    )
    generic = requests.where(F.coalesce("job_id", F.lit("")) == "").select("request_id", F.lit("generic").alias("result"))
    return shown.unionByName(generic, allowMissingColumns=True)


def job_description(listings: DataFrame, language: str) -> DataFrame:
    """Board listings with their sections joined under localized headings, and their cities."""
    which = 0 if language == "de" else 1

    def part(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    pieces = [part("introduction")]
    for section, heading in HEADINGS.items():
        pieces += [F.lit(heading[which]), part(section)]
    return listings.select(
        "referencenumber", "title", join_list(F.col("cities")).alias("city"), F.concat(*pieces).alias("description")
    )


BONUS_FIELDS = ["bonus", "shifts", "start_date", "end_date", "city", "job", "terms"]
PLACES = "array<struct<city:string,jobs:string>>"


def bonus_program(bonuses: DataFrame, requests: DataFrame) -> DataFrame:
    """Requested bonus programs with the text listing their cities and jobs.

    ``bonuses`` has ``bonus_id``, ``row_no``, the fields above and ``job_en``, a JSON list of
    cities with jobs. The last row of an id counts.
    """
    picked = row_by_id(
        bonuses.withColumnRenamed("bonus_id", "_bonus_id"), requests, "_bonus_id", "bonus_id"
    )
    return picked.withColumn("places", F.from_json("job_en", PLACES)).select(
        *requests.columns,
        F.when(F.col("found"), F.lit("ok")).otherwise(F.lit("bonusNotFound")).alias("result"),
        *BONUS_FIELDS,
        "places",
        join_pairs(F.col("places"), "city", "jobs").alias("places_text"),
    )


def bonus_places(programs: DataFrame) -> DataFrame:
    """One row per city of a bonus program."""
    return programs.select("request_id", "bonus_id", F.posexplode("places").alias("place_no", "_place")).select(
        "request_id", "bonus_id", "place_no", F.col("_place.city").alias("city"), F.col("_place.jobs").alias("jobs")
    )
