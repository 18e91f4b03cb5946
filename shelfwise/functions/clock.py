"""Epoch-second bounds relative to an explicit point in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds in a day and in ten minutes.
DAY = 24 * 60 * 60
TEN_MINUTES = 10 * 60


def ntz_epoch(ts: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC, whatever the session zone is."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * DAY
        + F.hour(ts).cast("long") * 3600
        + F.minute(ts).cast("long") * 60
        + F.second(ts).cast("long")
    )


def day_ago(as_of: Column) -> Column:
    return as_of - DAY


def ten_minutes_ago(as_of: Column) -> Column:
    return (as_of - TEN_MINUTES).cast("string")


def midnight(as_of: Column, zone: str = "UTC") -> Column:
    """Start of the day of ``as_of`` in ``zone``, as epoch seconds in text."""
    local = F.from_utc_timestamp(F.timestamp_seconds(as_of), zone)
    start = F.to_utc_timestamp(F.date_trunc("day", local), zone)
    return F.unix_timestamp(start).cast("string")


def epoch_bounds(as_of: Column, zone: str = "UTC") -> list[Column]:
    return [
        as_of.alias("now"),
        day_ago(as_of).alias("day_ago"),
        ten_minutes_ago(as_of).alias("ten_minutes_ago"),
        midnight(as_of, zone).alias("midnight"),
    ]
