"""Existence joins: keep rows whose key occurs in another result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A calendar bounds the number of days; a frame of days is always small.
DAYS_PER_CENTURY = 36_525
FIRST_DATE = "0001-01-01"


def keep_known(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` occurs in ``keys``; never duplicates a row.

    No hint: Spark broadcasts ``keys`` when its size is under the broadcast
    threshold and shuffles both sides otherwise.
    """
    return df.join(keys.select(on), on, "left_semi")


def keep_days(df: DataFrame, days: DataFrame, on: str, month: str | None = None) -> DataFrame:
    """Rows of a fact whose day occurs in ``days``, without shuffling the fact.

    ``days`` holds distinct dates, at most ``DAYS_PER_CENTURY`` per century of
    data, so it is broadcast.  ``month`` is the column by which the stored fact is
    partitioned, if it is: Spark then reads the months of those days only.
    """
    wanted = days.select(on)
    if month is None:
        return df.join(F.broadcast(wanted), on, "left_semi")
    # Spark prunes by a frame that a comparison has cut down, and by no other; this one
    # holds for every date.
    wanted = wanted.filter(F.col(on) >= F.lit(FIRST_DATE).cast("date"))
    wanted = wanted.withColumn(month, F.trunc(on, "month"))
    return df.join(F.broadcast(wanted), [month, on], "left_semi")


def keep_top(df: DataFrame, ranked: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` occurs in a top-k result.

    No hint: the result of a limit has a known small size, so Spark broadcasts
    it, and any larger frame is shuffled.
    """
    return keep_known(df, ranked, on)
