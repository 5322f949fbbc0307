"""Rules for hashed e-mail addresses, the key of a respondent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canvass.functions.text import blank_to_null, strip

# Fixed value: SHA-256 as lower-case hex.
HASH_SHAPE = "^[0-9a-f]{64}$"


def normalised_hash(raw: Column) -> Column:
    return blank_to_null(F.lower(strip(raw)))


def is_hash(value: Column) -> Column:
    return F.coalesce(value.rlike(HASH_SHAPE), F.lit(False))


def email_hash(email: Column) -> Column:
    return F.sha2(F.lower(strip(email)), 256)


def resolved_hash(payload: Column, recovered: Column) -> Column:
    """struct(hem, hem_source): the payload's hash if valid, else the one recovered from events, else NULLs."""
    own, found = normalised_hash(payload), normalised_hash(recovered)
    return F.struct(
        F.when(is_hash(own), own).when(is_hash(found), found).alias("hem"),
        F.when(is_hash(own), F.lit("payload")).when(is_hash(found), F.lit("events")).alias("hem_source"),
    )
