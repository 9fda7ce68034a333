"""Pivot to a matrix and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_matrix(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence[str], fill=None
) -> DataFrame:
    """One row per ``row``, one column per listed category; duplicates are averaged.

    The categories are an argument, so Spark needs no extra job to find them.
    """
    wide = df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))
    if fill is None:
        return wide
    # Category names may contain dots, so they are quoted.
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(fill)).alias(c) for c in columns]
    return wide.select(row, *cells)


def unpivot_matrix(
    df: DataFrame, row: str, columns: Sequence[str], column: str, value: str
) -> DataFrame:
    """Back to long form: one row per row key and category."""
    return df.unpivot([row], list(columns), column, value)


def with_lookup(df: DataFrame, lookup: DataFrame, on: str, name: str, default="") -> DataFrame:
    """Column ``name`` from a lookup frame; the default where there is no match."""
    joined = df.join(lookup.select(on, name), on, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
