"""Item results: engagement contrast, negativity by price tier, ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.labels import (
    EARLY_LABEL,
    RELEASED_LABEL,
    TIERS,
    non_empty,
    price_tier,
    two_way,
)
from reviewlens.functions.measures import pct, ratio
from reviewlens.operators.distribution import ecdf
from reviewlens.operators.members import primary_member
from reviewlens.operators.reshape import pivot_matrix

HALF = 0.5


def engagement_contrast(
    summary: DataFrame, items: DataFrame, more_than: int = 50
) -> DataFrame:
    """Mean hours of up-votes and of down-votes per item with more than so many played reviews.

    Items with only one kind of vote have nothing to compare and are left out.
    """
    means = ["avg_hours_positive", "avg_hours_negative"]
    return (
        summary.filter(F.col("played_reviews") > more_than)
        .select(
            "item_id",
            ratio("hours_up_sum", "hours_up_rows").alias(means[0]),
            ratio("hours_down_sum", "hours_down_rows").alias(means[1]),
            F.col("played_reviews").alias("total_reviews"),
        )
        .dropna(subset=means)
        .join(items.select("item_id", "item_name"), "item_id")
        .select("item_id", "item_name", *means, "total_reviews")
    )


def _priced(
    summary: DataFrame, items: DataFrame, more_than: int, tiers: Sequence[str]
) -> DataFrame:
    """Items above the threshold with percentage of down-votes and price tier."""
    return (
        summary.filter(F.col("reviews") > more_than)
        .withColumn("toxicity_percent", pct("negative", "reviews", 2))
        .join(items.select("item_id", "is_free", "price"), "item_id")
        .withColumn("price_tier", price_tier("is_free", "price", tiers))
    )


def negativity_by_tier(
    summary: DataFrame, items: DataFrame, more_than: int = 30, tiers: Sequence[str] = TIERS
) -> DataFrame:
    """Share of down-votes per item, with the item's price tier."""
    return _priced(summary, items, more_than, tiers).select(
        "item_id",
        F.col("reviews").alias("total_reviews"),
        F.col("negative").alias("negative_reviews"),
        "toxicity_percent",
        "price_tier",
    )


def access_label(early: str = EARLY_LABEL, released: str = RELEASED_LABEL) -> Column:
    """Early access when more than half of an item's rows carry the flag."""
    return two_way(ratio("early", "rows") > HALF, early, released)


def tier_access_matrix(
    summary: DataFrame,
    items: DataFrame,
    more_than: int = 30,
    tiers: Sequence[str] = TIERS,
    early: str = EARLY_LABEL,
    released: str = RELEASED_LABEL,
) -> DataFrame:
    """Mean of the items' percentages per price tier and kind of access.

    Tier and access come from the same item row, so nothing is joined to itself.
    """
    return (
        _priced(summary, items, more_than, tiers)
        .withColumn("access", access_label(early, released))
        .groupBy("price_tier", "access")
        .agg(F.avg("toxicity_percent").alias("avg_toxicity"))
    )


def tier_access_pivot(
    cells: DataFrame, early: str = EARLY_LABEL, released: str = RELEASED_LABEL
) -> DataFrame:
    return pivot_matrix(cells, "price_tier", "access", "avg_toxicity", [early, released])


def item_ratings(
    summary: DataFrame,
    items: DataFrame,
    owner_bridge: DataFrame,
    owners: DataFrame,
    at_least: int = 50,
) -> DataFrame:
    """Share of up-votes per named item, with its primary owner."""
    return (
        summary.filter(F.col("reviews") >= at_least)
        .select(
            "item_id",
            F.col("reviews").alias("total_reviews"),
            F.col("positive").alias("positive_reviews"),
            pct("positive", "reviews", 1).alias("pct_positive"),
        )
        .join(items.select("item_id", "item_name").filter(non_empty("item_name")), "item_id")
        .join(primary_member(owner_bridge, owners, "owner_id", "owner_name"), "item_id", "left")
        .select(
            "item_id",
            "item_name",
            "owner_name",
            "total_reviews",
            "positive_reviews",
            "pct_positive",
        )
    )


def negative_hours_cdf(negativity: DataFrame, contrast: DataFrame) -> DataFrame:
    """Distribution, per price tier, of the items' mean hours of down-votes."""
    joined = negativity.select("item_id", "price_tier").join(
        contrast.select("item_id", "avg_hours_negative").dropna(), "item_id"
    )
    return ecdf(joined, "price_tier", "avg_hours_negative", "item_id")
