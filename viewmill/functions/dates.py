"""Event time and integer calendar keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_local_time(c: Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss``; NULL for anything else, never an error."""
    return F.try_to_timestamp(c, F.lit(LOCAL_TIME_FORMAT))


def date_key(ts: Column) -> Column:
    """``yyyyMMdd`` as int, by arithmetic rather than by formatting and parsing text."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_key(ts: Column) -> Column:
    """``HHmm`` as int: 00:05 is 5."""
    return F.hour(ts) * 100 + F.minute(ts)


def sk_date_for(ds: str) -> int:
    """``2026-01-05`` -> ``20260105``; raises ``ValueError`` for an impossible day."""
    day = datetime.strptime(ds, "%Y-%m-%d")
    return day.year * 10000 + day.month * 100 + day.day
