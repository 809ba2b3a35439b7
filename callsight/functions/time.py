"""Time helpers. All column functions are built-in Catalyst expressions."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_label(epoch_ms: str | Column) -> Column:
    """``yyyy-MM-dd`` of an epoch-millisecond column in the session time zone.

    Seconds are truncated toward zero (``-500`` ms is still 1970-01-01), which is what
    a cast of the quotient to long does.
    """
    return F.from_unixtime((_col(epoch_ms) / 1000).cast("long"), "yyyy-MM-dd")


def day_date(epoch_ms: str | Column) -> Column:
    """The day of :func:`day_label` as a ``date`` (same truncation, same zone);
    ``date_format(day_date(c), 'yyyy-MM-dd') == day_label(c)``."""
    return F.to_date(F.timestamp_seconds((_col(epoch_ms) / 1000).cast("long")))


def event_hour(ts: str | Column) -> Column:
    """Start of the hour of ``ts`` (session time zone); a timestamp."""
    return F.date_trunc("hour", _col(ts))


def event_date(ts: str | Column) -> Column:
    return F.to_date(_col(ts))


def session_zone(spark: SparkSession) -> ZoneInfo:
    return ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))


def epoch_ms(spark: SparkSession, when: dt.date | dt.datetime | str | int) -> int:
    """Epoch milliseconds of a wall-clock date/time in the *session* zone.

    Bounds and labels then agree on which day an instant belongs to, whatever the
    zone of the driver process is. Integers are taken as epoch ms already.
    """
    if isinstance(when, int):
        return when
    if isinstance(when, str):
        when = dt.datetime.fromisoformat(when)
    if not isinstance(when, dt.datetime):
        when = dt.datetime(when.year, when.month, when.day)
    if when.tzinfo is None:
        when = when.replace(tzinfo=session_zone(spark))
    return int(when.timestamp() * 1000)


def day_window(spark: SparkSession, start, end=None) -> tuple[int, int]:
    """Half-open ``[start, end)`` in epoch ms; ``end`` defaults to the next day."""
    s = epoch_ms(spark, start)
    if end is None:
        if isinstance(start, str):
            start = dt.datetime.fromisoformat(start)
        e = epoch_ms(spark, start + dt.timedelta(days=1))
    else:
        e = epoch_ms(spark, end)
    return s, e
