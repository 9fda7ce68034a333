"""Date expressions.  All are UTC and independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens.functions.measures import as_column

SECONDS_PER_DAY = 86_400


def epoch_to_date(seconds: Column | str) -> Column:
    """UTC date of Unix seconds; unusable values become null."""
    days = F.floor(as_column(seconds).try_cast("double") / SECONDS_PER_DAY)
    return F.date_from_unix_date(days.try_cast("int"))


def month_start(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(as_column(day), "MM")


def parse_date(text: Column | str) -> Column:
    """Date from ISO text; malformed text becomes null."""
    return as_column(text).try_cast("date")


def iso_text(day: Column | str) -> Column:
    return F.date_format(as_column(day), "yyyy-MM-dd")
