"""Anonymizing and deleting users."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import pseudonym
from ..operators.payloads import batch_payloads

# What personal columns are overwritten with.
ANONYMOUS = {
    "email": "anonymized@user.com",
    "phone": "1234567890",
    "first_name": "anonymized",
    "last_name": "anonymized",
    "dob": "1970-01-01",
}


class Anonymized(NamedTuple):
    users: DataFrame
    rename_map: DataFrame
    update_payloads: DataFrame
    rename_payloads: DataFrame


def rename_map(ids: DataFrame, salt: str) -> DataFrame:
    """Current and new external id of every user to anonymize; null ids are left out."""
    user = F.col(ids.columns[0])
    return ids.select(user.alias("current_external_id"), pseudonym(user, salt).alias("new_external_id")).where(user.isNotNull()).distinct()


def anonymize_users(
    users: DataFrame, ids: DataFrame, salt: str, size: int = 50, shards: int | None = None
) -> Anonymized:
    """Overwrite the personal columns and the id of the listed users; leave the others alone."""
    listed = rename_map(ids, salt)
    flagged = users.join(listed, F.col("external_id") == F.col("current_external_id"), "left")
    hit = F.col("new_external_id").isNotNull()
    cleaned = flagged.withColumns(
        {
            "external_id": F.coalesce("new_external_id", "external_id"),
            **{c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in ANONYMOUS.items()},
        }
    ).drop("current_external_id", "new_external_id")
    update = F.struct(
        F.col("current_external_id").alias("external_id"), *[F.lit(v).alias(c) for c, v in ANONYMOUS.items()]
    )
    rename = F.struct("current_external_id", "new_external_id")
    return Anonymized(
        cleaned,
        listed,
        batch_payloads(listed, "current_external_id", update, "attributes", size, shards),
        batch_payloads(listed, "current_external_id", rename, "external_id_renames", size, shards),
    )


def delete_payloads(ids: DataFrame, size: int = 50, shards: int | None = None) -> DataFrame:
    """Deletion requests of at most 50 users each; null ids are left out."""
    users = ids.select(F.col(ids.columns[0]).cast("string").alias("external_id")).where("external_id IS NOT NULL").distinct()
    return batch_payloads(users, "external_id", F.col("external_id"), "external_ids", size, shards)
