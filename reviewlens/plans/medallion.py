"""Bronze → silver → gold: CSV files to typed tables to the published aggregates.

The gold tables keep their published names and columns, so existing consumers
can read them; :func:`load_gold` gives them back with canonical names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators.rollups import (
    item_day_summary,
    item_month_summary,
    item_months_of,
    item_summary,
    items_of,
)
from reviewlens.plans import anomalies, authors, categories, feeds, items, owners, reviews
from reviewlens.schemas import CANONICAL_TABLES, RAW_SCHEMAS, canonical_tables
from reviewlens.sources import files
from reviewlens.sources.files import scratch_folder
from reviewlens.sources.ingest import ingest_folder
from reviewlens.sources.readers import load_profile, load_tables, read_parts, read_table
from reviewlens.sources.writers import store, write_balanced

EXTRA_TABLE = "category_vote_engagement"

# Published gold tables and the columns renamed in them.
GOLD_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "engagement_contrast": ("gm_hater_paradox", {"item_id": "appid", "item_name": "app_name"}),
    "category_volume": ("gm_top_genres", {}),
    "negativity_by_tier": ("gm_toxicity_base", {"item_id": "appid"}),
    "flag_split": ("gm_early_access_split", {"early_access": "written_during_early_access"}),
    "category_sentiment": ("gm_sentiment_by_genre", {}),
    "log_hours_sample": ("gm_playtime_distribution", {"sentiment": "sentimiento"}),
    "tier_access_matrix": ("gm_toxicity_heatmap", {"access": "acceso_anticipado"}),
    "item_ratings": (
        "gm_game_ratings",
        {"item_id": "appid", "item_name": "app_name", "owner_name": "developer_name"},
    ),
    "most_active_authors": ("gm_top_users", {"author_id": "author_steamid"}),
    "author_profiles": ("gm_user_profiles", {"author_id": "author_steamid"}),
    "daily_volume": ("gm_daily_reviews", {}),
    "owner_performance": ("gm_developer_performance", {"owner_name": "developer_name"}),
    "category_timeline": ("gm_genre_timeline", {}),
}


def gold_order(name: str) -> list[Column]:
    """Published order of the rows of a gold table; empty where there is none."""
    return {
        "category_volume": [F.desc("review_count"), F.col("genre_name")],
        "daily_volume": [F.col("review_date")],
        "category_timeline": [F.col("review_month"), F.col("genre_name")],
    }.get(name, [])


@dataclass(frozen=True)
class Thresholds:
    """Published limits of the gold tables."""

    contrast_more_than: int = 50
    negativity_more_than: int = 30
    sentiment_more_than: int = 10_000
    rating_at_least: int = 50
    active_authors: int = 20
    profile_at_least: int = 3
    day_at_least: int = 100
    owner_items: int = 3
    owner_reviews: int = 200
    timeline_categories: int = 5
    hours_sample: float = 0.05
    profile_sample: float = 0.15


def build_silver(
    spark: SparkSession, raw_folder: str, silver_folder: str, by_month: bool = False
) -> dict[str, DataFrame]:
    """Every CSV file of the raw folder as a typed table.

    ``by_month`` stores the parts of the fact in a folder for each month, so that
    drill-downs to some days read the months of those days only.
    """
    return ingest_folder(
        spark, raw_folder, silver_folder, RAW_SCHEMAS, month_of={"reviews": "timestamp_created"} if by_month else None
    )


def silver_profile(spark: SparkSession, silver_folder: str) -> DataFrame:
    """Rows, types and filled values of each column of the silver tables."""
    found = load_silver_tables(spark, silver_folder)
    return load_profile(found)


def load_silver_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The silver tables as stored; the fact may be stored in parts."""
    raw = {
        name: read_table(spark, f"{folder}/{name}.parquet")
        for name in CANONICAL_TABLES
        if name != "reviews"
    }
    return {"reviews": read_parts(spark, folder, "reviews"), **raw}


def load_silver(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Canonical frames of the silver tables."""
    return canonical_tables(load_silver_tables(spark, folder))


def gold_frames(
    tables: dict[str, DataFrame],
    limits: Thresholds = Thresholds(),
    summary: DataFrame | None = None,
    base: DataFrame | None = None,
    by_author: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The thirteen aggregates, by analytic name, from canonical frames.

    Ten of them can be summed from ``base``, the summary by item, day and flag, and
    two from ``by_author``, the summary by author.  Pass stored ones, as
    :func:`build_gold` does, and the fact is read for the hours sample only.
    """
    fact, dims = tables["reviews"], tables["items"]
    if base is None:
        summary = item_summary(fact) if summary is None else summary
        months, split = item_month_summary(fact), reviews.flag_split(fact)
        daily = reviews.daily_volume(fact, limits.day_at_least)
    else:
        summary, months = items_of(base), item_months_of(base)
        split, daily = reviews.flag_split_of(base), reviews.daily_volume_of(base, limits.day_at_least)
    if by_author is None:
        active = authors.most_active_authors(fact, limits.active_authors)
        profiles = authors.author_profiles(fact, limits.profile_at_least, limits.profile_sample)
    else:
        active = authors.most_active_authors_of(by_author, limits.active_authors)
        profiles = authors.author_profiles_of(by_author, limits.profile_at_least, limits.profile_sample)
    genre_labels = categories.genre_labels(tables["genre_bridge"], tables["genres"])
    owner_labels = owners.owner_labels(tables["owner_bridge"], tables["owners"])
    volume = categories.category_volume(summary, genre_labels)
    return {
        "engagement_contrast": items.engagement_contrast(
            summary, dims, limits.contrast_more_than
        ),
        "category_volume": volume,
        "negativity_by_tier": items.negativity_by_tier(
            summary, dims, limits.negativity_more_than
        ),
        "flag_split": split,
        "category_sentiment": categories.category_sentiment(
            summary, genre_labels, limits.sentiment_more_than
        ),
        "log_hours_sample": reviews.log_hours_sample(fact, limits.hours_sample),
        "tier_access_matrix": items.tier_access_matrix(
            summary, dims, limits.negativity_more_than
        ),
        "item_ratings": items.item_ratings(
            summary, dims, tables["owner_bridge"], tables["owners"], limits.rating_at_least
        ),
        "most_active_authors": active,
        "author_profiles": profiles,
        "daily_volume": daily,
        "owner_performance": owners.owner_performance(
            summary, dims, owner_labels, limits.owner_items, limits.owner_reviews
        ),
        "category_timeline": categories.category_timeline(
            months, genre_labels, volume, limits.timeline_categories
        ),
    }


def published(df: DataFrame, name: str) -> DataFrame:
    """A gold frame with its published column names."""
    for ours, theirs in GOLD_TABLES[name][1].items():
        df = df.withColumnRenamed(ours, theirs)
    return df


def build_gold(
    spark: SparkSession,
    silver_folder: str,
    gold_folder: str,
    limits: Thresholds = Thresholds(),
    extras: bool = False,
) -> list[str]:
    """Write the gold tables; returns their names.

    The fact is read three times: for the summary by item, day and flag, for the
    summary by author, and for the hours sample.  Both summaries are written to the
    shared scratch folder, read by every table derived from them, and removed at the
    end.  ``extras`` adds the hours by category and vote, with a pass of its own.
    """
    tables = load_silver(spark, silver_folder)
    scratch = scratch_folder(spark)
    base = store(item_day_summary(tables["reviews"]), f"{scratch}/item_days.parquet")
    by_author = store(authors.author_summary(tables["reviews"]), f"{scratch}/authors.parquet")
    written = []
    for name, df in gold_frames(tables, limits, base=base, by_author=by_author).items():
        table = GOLD_TABLES[name][0]
        write_balanced(
            published(df, name), f"{gold_folder}/{table}.parquet", order=gold_order(name)
        )
        written.append(table)
    if extras:
        write_balanced(category_engagement(tables), f"{gold_folder}/{EXTRA_TABLE}.parquet")
        written.append(EXTRA_TABLE)
    files.delete(spark, scratch)
    return written


def load_gold(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Gold tables that exist, by analytic name with canonical columns, and the missing ones."""
    found, missing = load_tables(spark, folder, [table for table, _ in GOLD_TABLES.values()])
    gold = {}
    for name, (table, renamed) in GOLD_TABLES.items():
        if table in found:
            df = found[table]
            for ours, theirs in renamed.items():
                df = df.withColumnRenamed(theirs, ours)
            gold[name] = df
    return gold, missing


#: Feeds by name: the gold tables each needs, and how it is made of them.
FEEDS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "kpis": (("flag_split", "item_ratings", "owner_performance", "category_volume"), feeds.kpi_summary),
    "early_access": (("flag_split",), reviews.flag_shares),
    "top_genres": (("category_volume",), feeds.top_categories),
    "engagement_contrast": (("engagement_contrast",), feeds.engagement_contrast_feed),
    "best_items": (("item_ratings",), feeds.best_items),
    "worst_items": (("item_ratings",), feeds.worst_items),
    "sentiment_genre": (("category_sentiment",), feeds.top_category_sentiment),
    "genre_timeline": (("category_timeline",), feeds.category_timeline_dense),
    "toxicity_price": (("negativity_by_tier",), feeds.tier_box_summary),
    "toxicity_heatmap": (("tier_access_matrix",), items.tier_access_pivot),
    "negativity_series": (("daily_volume",), anomalies.negativity_anomalies),
    "cdf_price": (("negativity_by_tier", "engagement_contrast"), items.negative_hours_cdf),
    "top_users": (("most_active_authors",), feeds.most_active_authors_feed),
    "user_profiles": (("author_profiles",), feeds.author_profile_feed),
    "hours_box": (("log_hours_sample",), lambda sample: feeds.hours_distribution(sample)[0]),
    "hours_histogram": (("log_hours_sample",), lambda sample: feeds.hours_distribution(sample)[1]),
    "owner_ranking": (("owner_performance",), owners.owner_ranking),
    "owner_engagement_contrast": (
        ("item_ratings", "engagement_contrast", "owner_performance"),
        owners.owner_engagement_contrast,
    ),
}


def chart_feeds(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Chart-ready results from the gold tables that there are; other feeds are left out."""
    return {
        name: build(*[gold[table] for table in needed])
        for name, (needed, build) in FEEDS.items()
        if all(table in gold for table in needed)
    }


def category_engagement(tables: dict[str, DataFrame]) -> DataFrame:
    """Mean hours at the time of review per category and vote.

    Not one of the published gold tables; :func:`build_gold` writes it with
    ``extras``.
    """
    labels = categories.genre_labels(tables["genre_bridge"], tables["genres"])
    return categories.category_vote_engagement(tables["reviews"], tables["items"], labels)


def anomaly_report(
    tables: dict[str, DataFrame],
    gold: dict[str, DataFrame],
    language: str = anomalies.LANGUAGE,
    stop_words: Iterable[str] | None = None,
    fraction: float = 1.0,
    by_weight: bool = False,
) -> DataFrame:
    """The daily series with top items and keywords of its unusual days.

    ``fraction`` takes a sample of the texts, ``by_weight`` ranks keywords by
    weight; both go by ``review_id``.
    """
    flagged_series = anomalies.negativity_anomalies(gold["daily_volume"])
    days = anomalies.flagged_days(flagged_series)
    fact = tables["reviews"]
    text = anomalies.top_items_text(anomalies.top_items(fact, days, tables["items"]))
    said = anomalies.keywords(
        anomalies.reviews_on(fact, days),
        "review_date",
        language,
        key="review_id" if by_weight else None,
        by_weight=by_weight,
        fraction=fraction,
        stop_words=stop_words,
    )
    return anomalies.anomaly_report(flagged_series, text, said.select("review_date", "keywords"))
