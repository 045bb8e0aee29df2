"""Job intake (JSON) and job board listings (XML)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .xml_rows import read_xml_rows

# Field names of a posted job, and the feed column each one fills.
POSTED_FIELDS = {
    "referenceNumber": "referencenumber",
    "jobTitle": "title",
    "date": "date",
    "city": "city",
    "salary": "salary",
    "url": "url",
    "jobType": "jobtype",
    "description": "description",
    "endDate": "endDate",
    "language": "language",
}
JOB_EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in POSTED_FIELDS])

SECTIONS = ["introduction", "offer", "tasks", "profile", "contactinfo"]


def _struct(names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


_LOCATION = T.StructType(_struct(["city"]))
LISTING_SCHEMAS = {
    "stepstone": (
        "joblisting",
        T.StructType(
            [
                T.StructField("_reference_id", T.StringType()),
                T.StructField(
                    "jobdetails",
                    T.StructType(
                        [
                            T.StructField("jobtitle", T.StringType()),
                            T.StructField(
                                "joblocations",
                                T.StructType([T.StructField("location", T.ArrayType(_LOCATION))]),
                            ),
                            *_struct(SECTIONS),
                        ]
                    ),
                ),
            ]
        ),
    ),
    "jobsora": ("job", T.StructType(_struct(["_id", "name", "region", "salary", "description"]))),
}


def draft_row() -> list[Column]:
    """Feed columns of a posted job; every new job starts as a draft."""
    return [F.lit("DRAFT").alias("status"), *[F.col(old).alias(new) for old, new in POSTED_FIELDS.items()]]


def job_events(df: DataFrame, json_col: str) -> DataFrame:
    """Posted job texts as feed rows."""
    posted = F.from_json(F.col(json_col), JOB_EVENT_SCHEMA)
    return df.select(posted.alias("_job")).select("_job.*").select(*draft_row())


def read_job_events(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Posted jobs from JSON files, as a table or as a stream."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(JOB_EVENT_SCHEMA).json(path).select(*draft_row())


def read_job_xml(spark: SparkSession, path: str, board: str) -> DataFrame:
    """Listings of a job board under common names.

    ``stepstone`` listings keep their five text sections and a list of cities; ``jobsora``
    listings are flat.
    """
    row_tag, schema = LISTING_SCHEMAS[board]
    rows = read_xml_rows(spark, path, row_tag, schema)
    if board == "stepstone":
        details = "jobdetails"
        return rows.select(
            F.col("_reference_id").alias("referencenumber"),
            F.col(f"{details}.jobtitle").alias("title"),
            F.col(f"{details}.joblocations.location.city").alias("cities"),
            *[F.col(f"{details}.{section}") for section in SECTIONS],
        )
    return rows.select(
        F.col("_id").alias("referencenumber"),
        F.col("name").alias("title"),
        F.col("region").alias("city"),
        "salary",
        "description",
    )
