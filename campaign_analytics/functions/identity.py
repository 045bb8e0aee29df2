"""Pseudonyms and hash positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonym(user_id: Column, salt: str) -> Column:
    """SHA-256 of the id followed by the salt, in hex."""
    return F.sha2(F.concat(user_id.cast("string"), F.lit(salt)), 256)


def hash_slot(key: Column, slots: int, seed: str = "") -> Column:
    """Stable slot 0..slots-1 of a key: the first 8 hex digits of its seeded SHA-256."""
    digest = F.sha2(F.concat(key.cast("string"), F.lit(seed)), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(slots)).cast("int")
