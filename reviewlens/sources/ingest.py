"""CSV folder → typed Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reviewlens.schemas import RAW_SCHEMAS
from reviewlens.sources import files
from reviewlens.sources.csv import read_csv, read_csv_in_parallel
from reviewlens.sources.writers import write_balanced, write_by_month


def table_name(path: str) -> str:
    """Table name of a CSV file: the file name without its extension."""
    return path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")


def display_name(path: str) -> str:
    return table_name(path).replace("_", " ").title()


def ingest_file(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    schema: T.StructType | None = None,
    strict_quotes: bool = False,
    missing: str = "raise",
    month_of: str | None = None,
) -> DataFrame:
    """One CSV file to one typed Parquet table; returns the table.

    Every file is read the same way whatever its size: with a schema by many
    tasks, by the rules of Spark's own reader; without one by Spark's reader, which
    infers the types.  ``strict_quotes`` raises an error where a file is not
    strictly quoted; it needs a schema.  ``month_of`` names a column of epoch
    seconds: the table then has a folder for each month, and no size-balanced files.
    """
    if schema is not None:
        df = read_csv_in_parallel(spark, csv_path, schema, missing, strict=strict_quotes)
    elif strict_quotes:
        raise ValueError("strict_quotes needs a schema")
    else:
        df = read_csv(spark, csv_path, schema, missing)
    if month_of is None:
        write_balanced(df, table_path)
    else:
        write_by_month(df, table_path, month_of)
    return spark.read.parquet(table_path)


def ingest_folder(
    spark: SparkSession,
    csv_folder: str,
    table_folder: str,
    schemas: dict[str, T.StructType] | None = None,
    strict_quotes: bool = False,
    missing: str = "raise",
    month_of: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Every ``*.csv`` of a folder as a table; files without a schema are inferred.

    The target folder is made first.  A file that cannot be read raises its error and
    leaves no table there; tables written before it stay.  ``month_of`` gives for
    tables that are stored by month their column of epoch seconds.
    """
    schemas = RAW_SCHEMAS if schemas is None else schemas
    paths = files.matching(spark, f"{csv_folder}/*.csv")
    if not paths:
        raise FileNotFoundError(f"no *.csv in {csv_folder}")
    files.make_folder(spark, table_folder)
    tables = {}
    for path in paths:
        name = table_name(path)
        schema = _schema_for(name, schemas)
        month = next((c for t, c in (month_of or {}).items() if t in (name, name.split("_")[0])), None)
        tables[name] = ingest_file(
            spark, path, f"{table_folder}/{name}.parquet", schema, strict_quotes and schema is not None, missing, month
        )
    return tables


def _schema_for(name: str, schemas: dict[str, T.StructType]) -> T.StructType | None:
    """Schema of a table, or of the fact a numbered or dated part such as ``reviews_2024`` is of."""
    return schemas.get(name) or schemas.get(name.split("_")[0])
