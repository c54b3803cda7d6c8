"""Time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(c: Column) -> Column:
    """Seconds since the epoch with fractions; time zone free timestamps are taken in the session's zone."""
    return c.cast("timestamp").cast("double")


def hours_between(start: Column, end: Column, decimals: int = 2) -> Column:
    """Signed hours from ``start`` to ``end``; null where either is."""
    return F.round((seconds(end) - seconds(start)) / 3600, decimals)


def month_of(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def is_late(planned: Column, actual: Column, status: Column, late_status: str) -> Column:
    """Late by status or by time; what is unknown is not late."""
    return F.coalesce(status == late_status, F.lit(False)) | F.coalesce(actual > planned, F.lit(False))
