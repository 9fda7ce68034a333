"""Table scans: Parquet directories, multi-part facts, named sets, load reports."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.sources import files


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """One Parquet table.  Listed columns only reach the scan (``ReadSchema``)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def read_parts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A fact stored in several Parquet files or tables, as one table.

    Layouts: ``name_part<number>.parquet``, one ``name.parquet``, or
    ``name_<number>.parquet``.  Two layouts side by side raise an error, because
    one may repeat the rows of the other.
    """
    shapes = {
        f"{name}_part<number>": rf"{re.escape(name)}_part\d+\.parquet",
        name: rf"{re.escape(name)}\.parquet",
        f"{name}_<number>": rf"{re.escape(name)}_\d+\.parquet",
    }
    paths = files.matching(spark, f"{folder}/{name}*.parquet")
    found = {
        label: [p for p in paths if re.fullmatch(shape, p.rstrip("/").rsplit("/", 1)[-1])]
        for label, shape in shapes.items()
    }
    found = {label: parts for label, parts in found.items() if parts}
    if not found:
        raise FileNotFoundError(f"no {name}_part<number>.parquet and no {name}.parquet in {folder}")
    if len(found) > 1:
        raise ValueError(f"{folder} holds {name} in more than one layout: {', '.join(found)}")
    return spark.read.parquet(*next(iter(found.values())))


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Bag union by column name; duplicates stay."""
    return reduce(lambda left, right: left.unionByName(right), parts)


def load_tables(
    spark: SparkSession, folder: str, names: list[str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Tables that exist, by name, and the names that do not."""
    found, missing = {}, []
    for name in names:
        path = f"{folder}/{name}.parquet"
        if files.exists(spark, path):
            found[name] = spark.read.parquet(path)
        else:
            missing.append(name)
    return found, missing


def load_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and non-null values of every column, in one scan per table."""
    profiles = []
    for name, df in tables.items():
        counts = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(kind).alias("type"),
                    F.col(f"_{i}").alias("non_null"),
                )
                for i, (c, kind) in enumerate(df.dtypes)
            ]
        )
        profiles.append(
            counts.select(F.lit(name).alias("table"), "rows", F.explode(entries).alias("e"))
            .select("table", "e.column", "e.type", "rows", "e.non_null")
        )
    return union_parts(profiles)
