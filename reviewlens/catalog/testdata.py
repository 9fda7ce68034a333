"""The driver tables seen as review data.

A line item is a review of its part, an order's customer is the author, nations
are genres and suppliers are owners.  Review texts are the documents: the
document of a review is the one numbered by a fifteenth of its order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Thresholds that leave results on the driver tables; the library defaults
# would empty several of them.
ORDERS_PER_DOCUMENT = 15
CONTRAST_MORE_THAN = 20
NEGATIVITY_MORE_THAN = 30
SENTIMENT_MORE_THAN = 5_700
RATING_AT_LEAST = 30
PROFILE_AT_LEAST = 30
DAY_AT_LEAST = 20
OWNER_ITEMS = 187
OWNER_REVIEWS = 5_660
CLIP_HOURS = 900.0


def _epoch_seconds(moment: Column) -> Column:
    """Unix seconds of a time without zone, read as UTC whatever the session zone."""
    days = F.unix_date(moment.cast("date")).cast("bigint")
    return days * 86_400 + F.hour(moment) * 3_600 + F.minute(moment) * 60 + F.second(moment)


class Tables:
    """Canonical frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def documents(self) -> DataFrame:
        return self.raw("documents")

    def reviews(self, author: bool = False, key: bool = False) -> DataFrame:
        """The fact.  The author comes from a join and only where it is needed.

        An order has several lines; ``key`` adds a number of its own for each.
        """
        lines = self.raw("lineitem")
        columns = [
            F.col("l_orderkey").alias("review_id"),
            F.col("l_partkey").alias("item_id"),
            (F.col("l_returnflag") != "R").alias("recommended"),
            F.col("l_extendedprice").alias("minutes_played"),
            F.col("l_extendedprice").alias("minutes_at_review"),
            F.col("l_quantity").alias("items_owned"),
            (F.col("l_linestatus") == "F").alias("early_access"),
            _epoch_seconds(F.col("l_shipdate")).alias("created_at"),
        ]
        if key:
            columns.append((F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("text_key"))
        if author:
            orders = self.raw("orders").select("o_orderkey", "o_custkey")
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            columns.append(F.col("o_custkey").alias("author_id"))
        return lines.select(*columns)

    def with_text(self, reviews: DataFrame) -> DataFrame:
        """Reviews with language and text.  Restrict the reviews first: texts are wide."""
        documents = self.documents().select(
            "doc_id", F.col("lang").alias("language"), F.col("text").alias("review_text")
        )
        number = F.expr(f"review_id DIV {ORDERS_PER_DOCUMENT}")
        return reviews.join(documents, number == F.col("doc_id")).drop("doc_id")

    def items(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            (F.col("p_brand") == "Brand#1").alias("is_free"),
            F.col("p_size").cast("double").alias("price"),
        )

    def genres(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("genre_id"), F.col("n_name").alias("genre_name")
        )

    def owners(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("owner_id"), F.col("s_name").alias("owner_name")
        )

    def genre_bridge(self) -> DataFrame:
        suppliers = self.raw("supplier").select("s_suppkey", "s_nationkey")
        return (
            self.raw("lineitem")
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(F.col("l_partkey").alias("item_id"), F.col("s_nationkey").alias("genre_id"))
            .distinct()
        )

    def owner_bridge(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("owner_id"))
            .distinct()
        )

    def texts(self) -> DataFrame:
        """Documents by source; a document counts as negative when labelled toxic."""
        labels = self.raw("labels").select("doc_id", "toxic")
        return (
            self.documents()
            .join(labels, "doc_id", "left")
            .select(
                "doc_id",
                F.col("source").alias("grp"),
                F.col("lang").alias("language"),
                F.col("text").alias("review_text"),
                (F.coalesce("toxic", F.lit(0)) != 1).alias("recommended"),
            )
        )
