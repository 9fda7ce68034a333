"""Top-k, bottom-k, top-k per group and ranked text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, ties: list[str]) -> DataFrame:
    """The k rows with the largest measure; ``ties`` makes the choice unique."""
    return df.orderBy(F.desc_nulls_last(measure), *ties).limit(k)


def bottom_k(df: DataFrame, measure: str, k: int, ties: list[str]) -> DataFrame:
    """The k rows with the smallest measure; rows without a measure come last."""
    return df.orderBy(F.asc_nulls_last(measure), *ties).limit(k)


def top_k_per_group(
    df: DataFrame, group: str, measure: str, k: int, ties: list[str], rank: str = "rank"
) -> DataFrame:
    """The k largest rows of each group.

    Spark cuts each input partition to k rows per group before the shuffle, so
    a very large group does not reach one task whole.
    """
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(measure), *ties)
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def ranked_text(
    df: DataFrame, group: str, rank: str, text: Column | str, separator: str, name: str
) -> DataFrame:
    """One line of text per group from a few ranked rows, in rank order.

    Meant for the output of :func:`top_k_per_group`, which bounds the rows per
    group.  Rows whose text is null are left out.
    """
    text = F.col(text) if isinstance(text, str) else text
    entry = F.when(text.isNotNull(), F.struct(F.col(rank).alias("rank"), text.alias("text")))
    entries = F.array_sort(F.collect_list(entry))
    return df.groupBy(group).agg(
        F.array_join(F.transform(entries, lambda e: e["text"]), separator).alias(name)
    )
