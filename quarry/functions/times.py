"""Epoch and calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_timestamp(c: Column) -> Column:
    """X3 (parity): ``cast(from_unixtime(c/1000) as timestamp)``.  ``c/1000``
    is a double cut to whole seconds toward zero; milliseconds are lost and
    the value passes through session-zone text."""
    return F.from_unixtime((c / 1000).cast("long")).cast("timestamp")


def epoch_ms_to_timestamp_ntz(c: Column) -> Column:
    """X3 with a zone-free result (same whole-second value)."""
    return F.from_unixtime((c / 1000).cast("long")).cast("timestamp_ntz")


def epoch_ms_to_timestamp_exact(c: Column) -> Column:
    """X3 (sound): keeps milliseconds, no text round trip."""
    return F.timestamp_millis(c)


def epoch_ms_to_text(c: Column) -> Column:
    """``from_unixtime(c/1000)`` without a cast: text in the session zone."""
    return F.from_unixtime((c / 1000).cast("long"))


def epoch_millis_ntz(c: Column) -> Column:
    """Epoch milliseconds of a zone-free timestamp, read as UTC, whatever
    the session zone: the cast to a zoned timestamp reads the wall clock in
    the session zone and ``from_utc_timestamp`` adds that zone's offset back,
    leaving the wall clock counted from the epoch."""
    return F.unix_millis(F.from_utc_timestamp(c.cast("timestamp"), F.current_timezone()))


def cutoff_parts(as_of: dt.date, days: int) -> tuple[str, str, str]:
    """``as_of - days`` split into zero-padded ``Y``, ``m``, ``d``.  The
    run date is an argument so a run can be repeated."""
    d = as_of - dt.timedelta(days=days)
    return d.strftime("%Y"), d.strftime("%m"), d.strftime("%d")
