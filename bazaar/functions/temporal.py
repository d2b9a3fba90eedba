"""Timestamp helpers for zone-less (TIMESTAMP_NTZ) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_boundaries_between(start: Column, end: Column) -> Column:
    """Number of hour boundaries crossed from ``start`` to ``end`` (BIGINT).

    This is calendar ``date_diff('hour', start, end)``: 10:59 -> 11:01 is 1,
    11:00 -> 11:59 is 0. Spark's ``timestampdiff(HOUR, ...)`` counts elapsed
    whole hours instead, so the count is built from the calendar fields,
    which needs no time zone for NTZ values.
    """
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * F.lit(24) + (F.hour(end) - F.hour(start)).cast("long")


def minus_days(ts: Column, days: int) -> Column:
    """ts - INTERVAL 'days' DAY, keeping the timestamp type."""
    return F.timestamp_add("DAY", F.lit(-days), ts)
