"""Deterministic train / validation / test assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket count, first validation bucket, first test bucket, split names.
BUCKETS = 10
VALIDATION_FROM = 6
TEST_FROM = 8
TRAIN, VALIDATION, TEST = "train", "validation", "test"


def bucket_of(created_at: Column, *ids: Column) -> Column:
    """Last digit of the time. Rows without a time are spread by a hash of their ids."""
    digit = (created_at % BUCKETS).cast("int")
    if not ids:
        return digit
    return F.coalesce(digit, F.pmod(F.xxhash64(*ids), F.lit(BUCKETS)).cast("int"))


def split_of(bucket: Column) -> Column:
    return (
        F.when(bucket < VALIDATION_FROM, TRAIN)
        .when(bucket < TEST_FROM, VALIDATION)
        .when(bucket >= TEST_FROM, TEST)
    )
