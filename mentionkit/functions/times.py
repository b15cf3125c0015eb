"""Time conversions. All assume a session in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to timestamp; NULL if it does not parse."""
    return F.try_to_timestamp(text)


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def iso_to_epoch(text: Column) -> Column:
    return F.unix_seconds(parse_iso(text))


def post_date(ts: Column) -> Column:
    return F.to_date(ts)


def week_start(ts: Column) -> Column:
    """Midnight of the Monday of the week."""
    return F.date_trunc("week", ts)
