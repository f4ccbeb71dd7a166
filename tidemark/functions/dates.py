"""Dates given by callers, and dates held in change times and file names."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def as_date(value: date | str) -> date:
    """A date, or text in exactly the form YYYY-MM-DD."""
    if isinstance(value, datetime):
        raise ValueError(f"expected a date without a time, got {value!r}")
    if isinstance(value, date):
        return value
    if not isinstance(value, str) or not _ISO_DAY.fullmatch(value):
        raise ValueError(f"expected a date as YYYY-MM-DD, got {value!r}")
    return date.fromisoformat(value)


def midnight(day: date) -> str:
    """The first change time of a day, in the exporter's text form."""
    return f"{day} 00:00:00.000000"


def change_day(stamp: Column, bad_timestamp: str = "fail") -> Column:
    """Day of a change time. Malformed text raises, whatever the session's ANSI setting,
    or becomes null under "drop"; a missing time is null either way."""
    day = F.try_to_date(stamp)
    if bad_timestamp == "drop":
        return day
    message = F.concat(F.lit("malformed change time: "), stamp)
    return F.coalesce(day, F.when(stamp.isNotNull(), F.raise_error(message).cast("date")))


def file_day(file_name: Column) -> Column:
    """Day a change file is named after, or null when the name has no valid date."""
    head = F.substring(file_name, 1, 8)
    return F.when(head.rlike("^[0-9]{8}$"), F.try_to_date(head, "yyyyMMdd"))


def compact(day: date) -> str:
    """A day the way file names spell it."""
    return day.strftime("%Y%m%d")
