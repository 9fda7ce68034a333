"""Author results: most active authors and author profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.measures import count_where, hours, rate, ratio
from reviewlens.functions.sampling import hash_sample
from reviewlens.operators.ranking import top_k


def most_active_authors(reviews: DataFrame, k: int = 20) -> DataFrame:
    """The k authors with most reviews, their share of up-votes and mean library size."""
    by_author = (
        reviews.filter(F.col("author_id").isNotNull())
        .groupBy("author_id")
        .agg(
            F.count("review_id").alias("num_reviews"),
            rate("recommended").alias("positivity_rate"),
            F.avg("items_owned").alias("avg_games_owned"),
        )
    )
    return top_k(by_author, "num_reviews", k, ["author_id"])


def author_profiles(
    reviews: DataFrame, at_least: int = 3, fraction: float = 0.15
) -> DataFrame:
    """Profiles of a sample of the authors with enough reviews and a known library.

    The sample depends on the author id only.  It is taken before the rows are
    shuffled, which gives the same profiles as sampling them at the end.
    """
    known = hash_sample(
        reviews.filter(
            F.col("author_id").isNotNull()
            & F.col("items_owned").isNotNull()
            & (F.col("items_owned") > 0)
        ),
        "author_id",
        fraction,
    )
    return (
        known.groupBy("author_id")
        .agg(
            F.avg("items_owned").alias("games_owned"),
            F.count("review_id").alias("reviews_written"),
            rate("recommended").alias("positivity_rate"),
            F.avg(hours("minutes_played")).alias("avg_playtime_hours"),
        )
        .filter(F.col("reviews_written") >= at_least)
    )


def author_summary(reviews: DataFrame) -> DataFrame:
    """Sums per author, over all rows and over those with a known library (``known_``).

    Both author results can be taken from it, so the fact is read once for them.
    """
    owned, played = F.col("items_owned"), hours("minutes_played")
    known = owned.isNotNull() & (owned > 0)
    return (
        reviews.filter(F.col("author_id").isNotNull())
        .groupBy("author_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("review_id").alias("reviews"),
            count_where("recommended").alias("positive"),
            F.sum(owned).alias("owned_sum"),
            F.count(owned).alias("owned_rows"),
            count_where(known).alias("known_rows"),
            F.count(F.when(known, F.col("review_id"))).alias("known_reviews"),
            count_where(known & F.col("recommended")).alias("known_positive"),
            F.sum(F.when(known, owned)).alias("known_owned_sum"),
            F.sum(F.when(known, played)).alias("known_hours_sum"),
            F.count(F.when(known, played)).alias("known_hours_rows"),
        )
    )


def most_active_authors_of(summary: DataFrame, k: int = 20) -> DataFrame:
    """:func:`most_active_authors` from :func:`author_summary`."""
    by_author = summary.select(
        "author_id",
        F.col("reviews").alias("num_reviews"),
        ratio("positive", "rows").alias("positivity_rate"),
        ratio("owned_sum", "owned_rows").alias("avg_games_owned"),
    )
    return top_k(by_author, "num_reviews", k, ["author_id"])


def author_profiles_of(
    summary: DataFrame, at_least: int = 3, fraction: float = 0.15
) -> DataFrame:
    """:func:`author_profiles` from :func:`author_summary`."""
    return hash_sample(summary, "author_id", fraction).filter(
        (F.col("known_rows") > 0) & (F.col("known_reviews") >= at_least)
    ).select(
        "author_id",
        ratio("known_owned_sum", "known_rows").alias("games_owned"),
        F.col("known_reviews").alias("reviews_written"),
        ratio("known_positive", "known_rows").alias("positivity_rate"),
        ratio("known_hours_sum", "known_hours_rows").alias("avg_playtime_hours"),
    )
