"""Owner (developer) results over the item ↔ owner bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.measures import cap, ratio
from reviewlens.operators.members import SALTS, item_labels, sum_by_label
from reviewlens.operators.ranking import top_k
from reviewlens.operators.restrict import keep_known

SIZE_CAP = 50


def owner_labels(owner_bridge: DataFrame, owners: DataFrame) -> DataFrame:
    return item_labels(owner_bridge, owners, "owner_id", "owner_name")


def owner_performance(
    summary: DataFrame,
    items: DataFrame,
    labels: DataFrame,
    min_items: int = 3,
    min_reviews: int = 200,
) -> DataFrame:
    """Items, reviews, share of up-votes and mean hours per owner name.

    Owners are many, so the owners of one item are spread over several tasks.
    """
    sums = ["reviews", "rows", "positive", "hours_sum", "hours_rows"]
    return (
        sum_by_label(
            keep_known(summary, items, "item_id"), labels, "owner_name", sums, salts=SALTS
        )
        .filter((F.col("items") >= min_items) & (F.col("reviews") >= min_reviews))
        .select(
            "owner_name",
            F.col("items").alias("num_games"),
            F.col("reviews").alias("total_reviews"),
            ratio("positive", "rows").alias("positivity_rate"),
            ratio("hours_sum", "hours_rows").alias("avg_playtime_hours"),
        )
    )


def owner_ranking(performance: DataFrame, k: int = 20) -> DataFrame:
    return top_k(performance, "total_reviews", k, ["owner_name"])


def owner_engagement_contrast(
    ratings: DataFrame, contrast: DataFrame, performance: DataFrame, size_cap: int = SIZE_CAP
) -> DataFrame:
    """Mean of the item means per primary owner, with that owner's overall numbers."""
    means = ["avg_hours_positive", "avg_hours_negative"]
    return (
        ratings.select("item_id", "owner_name")
        .dropna(subset=["owner_name"])
        .join(contrast.select("item_id", *means), "item_id")
        .groupBy("owner_name")
        .agg(*[F.avg(c).alias(c) for c in means])
        .join(
            performance.select("owner_name", "num_games", "positivity_rate", "total_reviews"),
            "owner_name",
        )
        .withColumn("marker_size", cap("num_games", size_cap) * 2 + 5)
    )
