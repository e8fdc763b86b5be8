"""Clock texts, time stamps of batch logs, and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_TIME_FORMAT = "M/d/yyyy H:mm:ss"


def log_timestamp(text: Column) -> Column:
    """Time stamp of a log line; one- and two-digit months, days and hours.

    Log times name no zone, so they are kept without one.
    """
    return F.to_timestamp_ntz(text, F.lit(LOG_TIME_FORMAT))


def clock_seconds(text: Column) -> Column:
    """Whole seconds of an ``H:mm:ss`` text; a missing text stays missing.

    Days before the clock (``2 days 3:04:05``) count, as do fractions, which are
    cut off after adding.
    """
    days = F.regexp_extract(text, r"^\s*(\d+)\s+days?\s", 1)
    clock = F.split(F.regexp_replace(F.trim(text), r"^\d+\s+days?\s+", ""), ":")
    hours, minutes = (clock.getItem(i).cast("bigint") for i in range(2))
    seconds = F.floor(clock.getItem(2).cast("decimal(18,9)")).cast("bigint")
    whole_days = F.when(days != "", days).otherwise("0").cast("bigint")
    return whole_days * 86400 + hours * 3600 + minutes * 60 + seconds


def add_seconds(moment: Column, seconds: Column) -> Column:
    return moment + F.make_dt_interval(secs=seconds)


def microseconds_between(start: Column, end: Column) -> Column:
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint")


def duration_text(seconds: Column) -> Column:
    """Duration as ``d days HH:mm:ss``."""
    whole = seconds.cast("bigint")
    days = F.floor(whole / 86400)
    rest = whole - days * 86400
    clock = F.format_string(
        "%02d:%02d:%02d",
        F.floor(rest / 3600),
        F.floor(F.pmod(rest, F.lit(3600)) / 60),
        F.pmod(rest, F.lit(60)),
    )
    return F.concat(days.cast("string"), F.lit(" days "), clock)
