"""Data model: raw table schemas and the library's column names.

The raw names are those of the CSV files.  Operators work on the canonical
names, so a dataset with other names needs one renaming step only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions.measures import to_key, to_number

LONG, DOUBLE, BOOLEAN, STRING = T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()


def struct_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw tables, their columns and types.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "reviews": struct_of(
        recommendationid=LONG,
        appid=LONG,
        author_steamid=LONG,
        voted_up=BOOLEAN,
        author_playtime_forever=DOUBLE,
        author_playtime_at_review=DOUBLE,
        author_num_games_owned=LONG,
        written_during_early_access=BOOLEAN,
        timestamp_created=LONG,
        language=STRING,
        review_text=STRING,
    ),
    "applications": struct_of(appid=LONG, name=STRING, is_free=BOOLEAN, mat_initial_price=DOUBLE),
    "genres": struct_of(id=LONG, name=STRING),
    "application_genres": struct_of(appid=LONG, genre_id=LONG),
    "developers": struct_of(id=LONG, name=STRING),
    "application_developers": struct_of(appid=LONG, developer_id=LONG),
}

# Raw table -> canonical table and raw column -> canonical column.
CANONICAL_TABLES: dict[str, str] = {
    "reviews": "reviews",
    "applications": "items",
    "genres": "genres",
    "application_genres": "genre_bridge",
    "developers": "owners",
    "application_developers": "owner_bridge",
}
CANONICAL_COLUMNS: dict[str, dict[str, str]] = {
    "reviews": {
        "recommendationid": "review_id",
        "appid": "item_id",
        "author_steamid": "author_id",
        "voted_up": "recommended",
        "author_playtime_forever": "minutes_played",
        "author_playtime_at_review": "minutes_at_review",
        "author_num_games_owned": "items_owned",
        "written_during_early_access": "early_access",
        "timestamp_created": "created_at",
        "language": "language",
        "review_text": "review_text",
    },
    "applications": {
        "appid": "item_id",
        "name": "item_name",
        "is_free": "is_free",
        "mat_initial_price": "price",
    },
    "genres": {"id": "genre_id", "name": "genre_name"},
    "application_genres": {"appid": "item_id", "genre_id": "genre_id"},
    "developers": {"id": "owner_id", "name": "owner_name"},
    "application_developers": {"appid": "item_id", "developer_id": "owner_id"},
}

# Partition column of a fact that is stored by month.
MONTH = "review_month"

KEYS = {"item_id", "genre_id", "owner_id"}
NUMBERS = {"minutes_played", "minutes_at_review", "items_owned", "price"}
FLAGS = {"recommended", "early_access", "is_free"}


def _typed(raw: str, name: str):
    """Canonical column of a raw one; values of a wrong type become null, not errors."""
    if name in KEYS:
        return to_key(raw).alias(name)
    if name in NUMBERS:
        return to_number(raw).alias(name)
    if name in FLAGS:
        return F.col(raw).try_cast("boolean").alias(name)
    return F.col(raw).alias(name)


def canonical(df: DataFrame, raw_table: str) -> DataFrame:
    """Raw table with canonical column names and types; absent columns are left out."""
    present = set(df.columns)
    columns = CANONICAL_COLUMNS[raw_table]
    kept = [_typed(raw, name) for raw, name in columns.items() if raw in present]
    if raw_table == "reviews" and MONTH in present:
        kept.append(F.col(MONTH))
    return df.select(*kept)


def canonical_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {CANONICAL_TABLES[name]: canonical(df, name) for name, df in raw.items()}
