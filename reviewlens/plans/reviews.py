"""Results straight from the fact: flag split, hours sample, daily volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.dates import epoch_to_date
from reviewlens.functions.labels import NEGATIVE_LABEL, POSITIVE_LABEL, two_way
from reviewlens.functions.measures import count_where, hours, log_hours
from reviewlens.functions.sampling import hash_sample
from reviewlens.operators.distribution import share_of_total
from reviewlens.operators.rollups import roll_up


def flag_split(reviews: DataFrame, flag: str = "early_access") -> DataFrame:
    """Reviews with and without the flag; rows with an unknown flag are left out."""
    return reviews.groupBy(flag).agg(F.count("review_id").alias("total_reviews")).dropna()


def flag_split_of(base: DataFrame, flag: str = "early_access") -> DataFrame:
    """:func:`flag_split` from a summary by item, day and flag."""
    return roll_up(base, F.col("flag").alias(flag), sums=["reviews"]).select(
        flag, F.col("reviews").alias("total_reviews")
    ).dropna()


def flag_shares(split: DataFrame) -> DataFrame:
    return share_of_total(split, "total_reviews")


def log_hours_sample(
    reviews: DataFrame,
    fraction: float = 0.05,
    key: str = "review_id",
    positive: str = POSITIVE_LABEL,
    negative: str = NEGATIVE_LABEL,
) -> DataFrame:
    """Log hours and vote label of a sample of the played reviews.

    An unknown vote is labelled negative.
    """
    return hash_sample(reviews, key, fraction).filter(hours("minutes_played") > 0).select(
        log_hours("minutes_played").alias("log_playtime"),
        two_way(F.col("recommended"), positive, negative).alias("sentiment"),
    )


def daily_volume(reviews: DataFrame, at_least: int = 100, ordered: bool = True) -> DataFrame:
    """Reviews, down-votes and up-votes per UTC day with enough reviews.

    ``ordered=False`` leaves out the final sort, for use in another step.
    """
    days = (
        reviews.withColumn("review_date", epoch_to_date("created_at"))
        .groupBy("review_date")
        .agg(
            F.count("review_id").alias("reviews"),
            count_where(~F.col("recommended")).alias("negative"),
            count_where("recommended").alias("positive"),
        )
    )
    return _busy_days(days, at_least, ordered)


def daily_volume_of(base: DataFrame, at_least: int = 100, ordered: bool = True) -> DataFrame:
    """:func:`daily_volume` from a summary by item, day and flag."""
    days = roll_up(base, "review_date", sums=["reviews", "negative", "positive"])
    return _busy_days(days, at_least, ordered)


def _busy_days(days: DataFrame, at_least: int, ordered: bool) -> DataFrame:
    kept = days.filter(F.col("review_date").isNotNull() & (F.col("reviews") >= at_least)).select(
        "review_date", F.col("reviews").alias("total"), "negative", "positive"
    )
    return kept.orderBy("review_date") if ordered else kept
