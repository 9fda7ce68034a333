"""Chart-ready results: rankings, summaries and key figures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.labels import (
    bar_text,
    compact_count,
    contains_text,
    grouped_count,
    percent_text,
)
from reviewlens.functions.measures import half_even, relative_size
from reviewlens.operators.distribution import box_summary, column_max, histogram
from reviewlens.operators.ranking import bottom_k, top_k
from reviewlens.operators.series import dense_grid
from reviewlens.sources.readers import union_parts

# Hours at the axis ticks of the log-hours chart.
TICK_HOURS = (0, 1, 10, 100, 500, 2000)
CLIP_HOURS = 500


def _rated(chosen: DataFrame) -> DataFrame:
    return chosen.dropna(subset=["item_name", "pct_positive"]).withColumn(
        "bar_text", bar_text("pct_positive", "total_reviews")
    )


def best_items(ratings: DataFrame, k: int = 20) -> DataFrame:
    return _rated(top_k(ratings, "pct_positive", k, ["item_id"]))


def worst_items(ratings: DataFrame, k: int = 20) -> DataFrame:
    return _rated(bottom_k(ratings, "pct_positive", k, ["item_id"]))


def tier_box_summary(negativity: DataFrame) -> DataFrame:
    """Box numbers of the items' percentages per price tier.

    The percentages have two places, so a tier has at most 10,001 values.
    """
    return box_summary(negativity, "price_tier", "toxicity_percent", few_values=True)


def hours_distribution(sample: DataFrame, bins: int = 24) -> tuple[DataFrame, DataFrame]:
    """Box numbers and a histogram of log hours per vote label."""
    top = float(TICK_HOURS[-1])
    return (
        box_summary(sample, "sentiment", "log_playtime"),
        histogram(sample, "sentiment", "log_playtime", 0.0, log_tick(top), bins),
    )


def log_tick(hours: float) -> float:
    """Position of an hour value on the log axis."""
    return math.log1p(hours)


def top_category_sentiment(sentiment: DataFrame, k: int = 15) -> DataFrame:
    """The k categories with the largest share of up-votes, smallest share first."""
    return top_k(sentiment, "pct_positive", k, ["genre_name"]).orderBy(
        "pct_positive", "genre_name"
    )


def top_categories(volume: DataFrame, k: int = 20) -> DataFrame:
    return top_k(volume, "review_count", k, ["genre_name"]).withColumn(
        "count_text", compact_count("review_count")
    )


def category_timeline_dense(timeline: DataFrame) -> DataFrame:
    """Every month × category of the timeline, zero where there was no review."""
    return dense_grid(timeline, "review_month", "genre_name", "review_count")


def engagement_contrast_feed(
    contrast: DataFrame, clip_hours: float = CLIP_HOURS, query: str | None = None
) -> DataFrame:
    """Items within the plotted range, with marker sizes, optionally searched by name."""
    shown = contrast.filter(
        (F.col("avg_hours_positive") <= clip_hours) & (F.col("avg_hours_negative") <= clip_hours)
    )
    largest = column_max(shown, "total_reviews")
    return shown.withColumn(
        "marker_size", relative_size("total_reviews", largest, 30, 4)
    ).filter(contains_text("item_name", query))


def author_profile_feed(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        F.col("author_id").cast("string").alias("author_text"),
        half_even("games_owned").cast("bigint").alias("games_owned"),
        "reviews_written",
        "positivity_rate",
        half_even(F.col("positivity_rate") * 100, 1).alias("positivity_pct"),
        half_even("avg_playtime_hours", 1).alias("avg_playtime_hours"),
    )


def most_active_authors_feed(authors: DataFrame) -> DataFrame:
    return authors.withColumn("author_text", F.col("author_id").cast("string")).orderBy(
        "num_reviews", "author_id"
    )


def _figure(name: str, value: Column, text: Column) -> Column:
    return F.struct(
        F.lit(name).alias("metric"), value.cast("double").alias("value"), text.alias("text")
    )


def kpi_summary(
    split: DataFrame, ratings: DataFrame, performance: DataFrame, volume: DataFrame
) -> DataFrame:
    """Five key figures: reviews, items, mean share of up-votes, owners, categories.

    Each input is reduced to one row where it is; the rows are put together.
    """
    total, mean, count = F.col("total"), F.col("mean"), F.count(F.lit(1)).alias("total")
    reviews = split.agg(F.coalesce(F.sum("total_reviews"), F.lit(0)).alias("total"))
    rated = ratings.agg(count, F.avg("pct_positive").alias("mean"))
    figures = [
        (reviews, [_figure("reviews", total, compact_count(total))]),
        (
            rated,
            [
                _figure("items", total, compact_count(total)),
                _figure("mean_positivity", mean, percent_text(mean)),
            ],
        ),
        (performance.agg(count), [_figure("owners", total, grouped_count(total))]),
        (volume.agg(count), [_figure("categories", total, grouped_count(total))]),
    ]
    return union_parts(
        [df.select(F.explode(F.array(*rows)).alias("f")).select("f.*") for df, rows in figures]
    )
