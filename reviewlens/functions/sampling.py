"""Row sampling that gives the same rows on every run and every retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.measures import as_column

HASH_DIGITS = 4
FINE_DIGITS = 12


def hash_threshold(fraction: float) -> str:
    """Hex bound below which a key's hash prefix falls with this probability.

    Four digits, or twelve for a fraction so near 0 or 1 that four cannot tell.
    """
    for digits in (HASH_DIGITS, FINE_DIGITS):
        bound = round(fraction * 16**digits)
        if 0 < bound < 16**digits:
            return format(bound, f"0{digits}x")
    return "" if fraction < 0.5 else "g"


def in_hash_sample(key: Column | str, fraction: float) -> Column:
    """True for about ``fraction`` of the distinct keys, decided by the key alone."""
    if fraction >= 1:
        return F.lit(True)
    digest = F.md5(as_column(key).cast("string").cast("binary"))
    bound = hash_threshold(fraction)
    return F.substring(digest, 1, max(1, len(bound))) < bound


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """About ``fraction`` of the rows; rows of one key stay or go together.

    A row without a key is decided by all its values.
    """
    row = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in df.columns])
    return df.filter(in_hash_sample(F.coalesce(F.col(key).cast("string"), row), fraction))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Spark's own sampling without replacement; depends on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
