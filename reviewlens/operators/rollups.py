"""One-pass summaries of the review fact.

``summarise`` computes every additive measure the analytics need.  A caller
that uses only some of them pays only for those: Catalyst drops the unused
aggregates and their columns never leave the Parquet scan.  All measures are
counts or sums, so they combine map-side, which keeps a very frequent item or
author from reaching one task as raw rows, and they can be summed again after
a join with a many-to-many bridge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.dates import epoch_to_date, month_start
from reviewlens.functions.measures import as_column, count_where, hours


def hour_measures(minutes: Column | str, prefix: str = "hours") -> list[Column]:
    """Sum and count of hours: over all rows, over up-votes and over down-votes."""
    minutes = as_column(minutes)
    up, down = F.col("recommended"), ~F.col("recommended")
    measures = []
    for suffix, value in (
        ("", minutes),
        ("_up", F.when(up, minutes)),
        ("_down", F.when(down, minutes)),
    ):
        measures.append(F.sum(hours(value)).alias(f"{prefix}{suffix}_sum"))
        measures.append(F.count(value).alias(f"{prefix}{suffix}_rows"))
    return measures


def vote_measures() -> list[Column]:
    """``rows`` counts every row; ``reviews`` counts rows that carry a review id."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count("review_id").alias("reviews"),
        count_where("recommended").alias("positive"),
        count_where(~F.col("recommended")).alias("negative"),
    ]


def summarise(reviews: DataFrame, *keys: Column | str) -> DataFrame:
    """Every additive measure of the fact at the grain of ``keys``."""
    played = F.when(F.col("minutes_played").isNotNull(), F.col("review_id"))
    return reviews.groupBy(*keys).agg(
        *vote_measures(),
        count_where("early_access").alias("early"),
        F.count(played).alias("played_reviews"),
        *hour_measures("minutes_played"),
    )


def item_day_summary(reviews: DataFrame) -> DataFrame:
    """One row per item, UTC day and early-access flag: what all results of items and
    dates can be summed from, so that the fact is read once for them."""
    dated = reviews.withColumn("review_date", epoch_to_date("created_at"))
    keys = [F.col("item_id"), F.col("review_date"), F.col("early_access").alias("flag")]
    return summarise(dated, *keys)


def item_summary(reviews: DataFrame) -> DataFrame:
    """One row per item; the shared base of the item, category and owner results."""
    return summarise(reviews, "item_id")


def item_month_summary(reviews: DataFrame) -> DataFrame:
    """Reviews per item and month; rows without a usable date have a null month."""
    month = month_start(epoch_to_date("created_at")).alias("review_month")
    return reviews.groupBy("item_id", month).agg(F.count("review_id").alias("reviews"))


def roll_up(summary: DataFrame, *keys: Column | str, sums: list[str] | None = None) -> DataFrame:
    """Coarser summary from a finer one, by summing additive measures (all of them by default)."""
    if sums is None:
        sums = [c for c in summary.columns if c not in ("item_id", "review_date", "flag")]
    return summary.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def items_of(base: DataFrame) -> DataFrame:
    """:func:`item_summary` from :func:`item_day_summary`."""
    return roll_up(base, "item_id")


def item_months_of(base: DataFrame) -> DataFrame:
    """:func:`item_month_summary` from :func:`item_day_summary`."""
    return roll_up(base, "item_id", month_start("review_date").alias("review_month"), sums=["reviews"])
