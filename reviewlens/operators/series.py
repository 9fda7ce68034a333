"""Ordered series: centred rolling bands, anomaly flags and dense grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW_ROWS = 30
MIN_ROWS = 10
# Slots of the categories of a dense grid.
GRID_SLOTS = 16
BAND_WIDTH = 2.0


def rolling_band(
    df: DataFrame,
    order: str,
    value: str,
    rows: int = WINDOW_ROWS,
    min_rows: int = MIN_ROWS,
    width: float = BAND_WIDTH,
    by: Sequence[str] = (),
) -> DataFrame:
    """Centred rolling mean and sample deviation over neighbouring rows, and the band.

    The frame counts rows, not calendar days; an even window has one more row
    before than after.  Mean and deviation are null with fewer than
    ``min_rows`` values in the frame.  Without ``by`` the series is one window:
    use it on a series with one row per day, which the calendar bounds.
    """
    frame = Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows // 2), (rows - 1) // 2)
    enough = F.count(value).over(frame) >= min_rows
    # Equal values have exactly their value as mean and no deviation; rounding
    # in the sums must not put a flat series above its own band.
    lowest = F.min(value).over(frame)
    flat = lowest == F.max(value).over(frame)
    average = F.when(flat, lowest).otherwise(F.avg(value).over(frame))
    deviation = F.when(flat & (F.count(value).over(frame) > 1), F.lit(0.0)).otherwise(
        F.stddev_samp(value).over(frame)
    )
    mean, sd = F.col("rolling_mean"), F.col("rolling_std")
    return (
        df.withColumn("rolling_mean", F.when(enough, average))
        .withColumn("rolling_std", F.when(enough, deviation))
        .withColumn("lower_band", mean - sd * width)
        .withColumn("upper_band", mean + sd * width)
    )


def flag_above(df: DataFrame, value: str, limit: str, name: str = "anomaly") -> DataFrame:
    """True where the value exceeds the limit; an unknown limit gives false."""
    return df.withColumn(name, F.coalesce(F.col(value) > F.col(limit), F.lit(False)))


def dense_grid(df: DataFrame, index: str, category: str, value: str, fill=0) -> DataFrame:
    """A row for every observed index × observed category; missing values filled.

    The result is the product of both sides by definition.  Each index value is
    repeated for ``GRID_SLOTS`` slots and meets the categories of a slot, so no
    number of categories is gathered anywhere: a key of the join holds one slot, and
    Spark broadcasts the categories where they are under its size threshold.
    """
    # The filter makes all uses below need the same columns, so that Spark
    # computes the input once.
    df = df.select(index, category, value).filter(F.col(value).isNotNull())
    slot = "_slot"
    slotted = F.pmod(F.xxhash64(category), F.lit(GRID_SLOTS)).cast("int")
    categories = df.select(category).filter(F.col(category).isNotNull()).distinct().withColumn(slot, slotted)
    indexes = df.select(index).distinct()
    every = indexes.withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(GRID_SLOTS - 1))))
    grid = every.join(categories, slot).drop(slot)
    return grid.join(df, [index, category], "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(fill))
    )
