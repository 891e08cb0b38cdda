"""Cutoff arithmetic: lookback in UTC, then wall clock in a named zone, then text.

The subtraction happens in UTC *before* the zone conversion; converting first
and subtracting after is an hour off across a DST change.  Timestamps are
``TIMESTAMP_NTZ`` throughout, so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two lookbacks and zones of the saved searches.
DAILY_LOOKBACK_MINUTES = 1441
DAILY_ZONE = "US/Pacific"
FREQUENT_LOOKBACK_MINUTES = 16
FREQUENT_ZONE = "US/Central"
CUTOFF_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def lookback(now_utc: Column, minutes: int) -> Column:
    """``now - minutes`` (SCL-3)."""
    return now_utc - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))


def to_zone(ts_utc: Column, zone: str) -> Column:
    """UTC wall clock -> wall clock in ``zone`` (SCL-4)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc)


def cutoff(now_utc: Column, minutes: int, zone: str) -> Column:
    """The search cutoff: ``to_zone(now - minutes, zone)``."""
    return to_zone(lookback(now_utc, minutes), zone)


def cutoff_text(ts: Column) -> Column:
    """``%Y-%m-%dT%H:%M:%S`` (SCL-5)."""
    return F.date_format(ts, CUTOFF_TEXT_FORMAT)
