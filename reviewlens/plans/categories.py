"""Category results over the item ↔ category bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.measures import pct, ratio
from reviewlens.operators.members import item_labels, sum_by_label
from reviewlens.operators.ranking import top_k
from reviewlens.operators.restrict import keep_known, keep_top
from reviewlens.operators.rollups import hour_measures

TOP_CATEGORIES = 5


def genre_labels(genre_bridge: DataFrame, genres: DataFrame) -> DataFrame:
    return item_labels(genre_bridge, genres, "genre_id", "genre_name")


def category_volume(summary: DataFrame, labels: DataFrame, label: str = "genre_name") -> DataFrame:
    """Reviews per category, largest first; a review counts once per category of its item."""
    return (
        sum_by_label(summary, labels, label, ["reviews"])
        .select(label, F.col("reviews").alias("review_count"))
        .orderBy(F.desc("review_count"), label)
    )


def category_sentiment(
    summary: DataFrame, labels: DataFrame, more_than: int = 10_000, label: str = "genre_name"
) -> DataFrame:
    """Up-votes, down-votes and their shares per category above the threshold."""
    return (
        sum_by_label(summary, labels, label, ["positive", "negative", "reviews"])
        .filter(F.col("reviews") > more_than)
        .select(
            label,
            "positive",
            "negative",
            F.col("reviews").alias("total"),
            pct("positive", "reviews", 1).alias("pct_positive"),
            pct("negative", "reviews", 1).alias("pct_negative"),
        )
    )


def category_timeline(
    item_months: DataFrame,
    labels: DataFrame,
    volume: DataFrame,
    k: int = TOP_CATEGORIES,
    label: str = "genre_name",
) -> DataFrame:
    """Reviews per month of the k largest categories."""
    largest = top_k(volume, "review_count", k, [label])
    dated = item_months.filter(F.col("review_month").isNotNull())
    return (
        sum_by_label(
            dated, keep_top(labels, largest, label), label, ["reviews"], keys=("review_month",)
        )
        .select("review_month", label, F.col("reviews").alias("review_count"))
        .orderBy("review_month", label)
    )


def category_vote_engagement(
    reviews: DataFrame,
    items: DataFrame,
    labels: DataFrame,
    minutes: str = "minutes_at_review",
    label: str = "genre_name",
) -> DataFrame:
    """Mean hours at the time of review per category and vote, two places.

    Rows without item, vote or hours do not take part.
    """
    complete = reviews.dropna(subset=["item_id", "recommended", minutes])
    by_vote = complete.groupBy("item_id", "recommended").agg(*hour_measures(minutes)[:2])
    known = keep_known(labels, items.dropna(subset=["item_id"]), "item_id")
    sums = ["hours_sum", "hours_rows"]
    return (
        sum_by_label(by_vote, known, label, sums, keys=("recommended",))
        .select(
            label,
            "recommended",
            F.round(ratio("hours_sum", "hours_rows"), 2).alias("avg_playtime_hours"),
        )
        .orderBy(F.desc("recommended"), F.desc("avg_playtime_hours"), label)
    )
