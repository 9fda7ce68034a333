"""Days of unusual negativity, and what was reviewed and said on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.dates import epoch_to_date
from reviewlens.functions.labels import grouped_count, non_empty
from reviewlens.functions.measures import pct
from reviewlens.functions.sampling import hash_sample
from reviewlens.operators.ranking import ranked_text, top_k_per_group
from reviewlens.operators.reshape import with_lookup
from reviewlens.operators.restrict import keep_days
from reviewlens.operators.series import (
    BAND_WIDTH,
    MIN_ROWS,
    WINDOW_ROWS,
    flag_above,
    rolling_band,
)
from reviewlens.operators.terms import MIN_TEXTS, group_keywords
from reviewlens.schemas import MONTH

# Texts of the published report.
NO_ITEMS_LABEL = "Sin datos"
LINE_BREAK = "<br>"
NEGATIVE_SUFFIX = "neg"
LANGUAGE = "english"


def negativity_anomalies(
    daily: DataFrame,
    rows: int = WINDOW_ROWS,
    min_rows: int = MIN_ROWS,
    width: float = BAND_WIDTH,
) -> DataFrame:
    """Daily share of down-votes against a centred rolling band.

    One row per retained day, so the single window is bounded by the calendar.
    """
    shares = daily.withColumn("neg_ratio", pct("negative", "total"))
    banded = rolling_band(shares, "review_date", "neg_ratio", rows, min_rows, width)
    return flag_above(banded, "neg_ratio", "upper_band")


def flagged_days(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter("anomaly").select("review_date")


def reviews_on(reviews: DataFrame, days: DataFrame) -> DataFrame:
    """Reviews of the given days; of a fact stored by month only those months are read."""
    month = MONTH if MONTH in reviews.columns else None
    dated = reviews.withColumn("review_date", epoch_to_date("created_at"))
    return keep_days(dated, days, "review_date", month)


def top_items(
    reviews: DataFrame, days: DataFrame, items: DataFrame, k: int = 3
) -> DataFrame:
    """The k items with most down-votes on each of the given days.

    Ranked by item id after the count; equal counts are ordered by name, then id.
    """
    return top_items_of(reviews_on(reviews, days), items, k)


def top_items_of(reviews: DataFrame, items: DataFrame, k: int = 3) -> DataFrame:
    """:func:`top_items` of reviews that are of the wanted days already."""
    hits = (
        reviews.filter(~F.col("recommended"))
        .groupBy("review_date", "item_id")
        .agg(F.count("review_id").alias("neg_count"))
        .join(items.select("item_id", "item_name"), "item_id", "left")
    )
    return top_k_per_group(hits, "review_date", "neg_count", k, ["item_name", "item_id"]).select(
        "review_date", "rank", "item_id", "item_name", "neg_count"
    )


def top_items_text(
    ranked: DataFrame, separator: str = LINE_BREAK, suffix: str = NEGATIVE_SUFFIX
) -> DataFrame:
    """The day's top items as one text; unnamed items are left out."""
    line = F.when(
        non_empty("item_name"),
        F.concat(
            F.lit("• "),
            F.col("item_name"),
            F.lit("  ("),
            grouped_count("neg_count"),
            F.lit(f" {suffix})"),
        ),
    )
    text = ranked_text(ranked, "review_date", "rank", line, separator, "top_items")
    return text.withColumn(
        "top_items", F.when(F.col("top_items") == "", NO_ITEMS_LABEL).otherwise(F.col("top_items"))
    )


def negative_texts(reviews: DataFrame, language: str | None = LANGUAGE) -> DataFrame:
    """Down-voted reviews with a text, in one language."""
    negative = reviews.filter(~F.col("recommended")).filter(non_empty("review_text"))
    return negative if language is None else negative.filter(F.col("language") == language)


def keywords(
    reviews: DataFrame,
    group: str,
    language: str | None = LANGUAGE,
    key: str | None = None,
    by_weight: bool = False,
    fraction: float = 1.0,
    min_texts: int = MIN_TEXTS,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Keywords of the negative texts of each group, such as a flagged day."""
    texts = negative_texts(reviews, language)
    if fraction < 1:
        texts = hash_sample(texts, key or "review_id", fraction)
    return group_keywords(
        texts,
        group,
        "review_text",
        key=key,
        by_weight=by_weight,
        min_texts=min_texts,
        stop_words=stop_words,
    )


def anomaly_report(
    anomalies: DataFrame, items_text: DataFrame, keyword_text: DataFrame
) -> DataFrame:
    """The series with, on flagged days, the most affected items and the keywords."""
    with_items = with_lookup(anomalies, items_text, "review_date", "top_items")
    return with_lookup(with_items, keyword_text, "review_date", "keywords")
