"""Shares, quantiles, box summaries, histograms and empirical distributions.

Ranks over a large category are computed without bringing the category into
one task.  A sample of rows, chosen by hash so that it is the same on every
evaluation, cuts the sort order into slots of about equally many rows; a window
numbers the rows within a slot, and the totals of the slots before it are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A slot of the sort order is one window group and has about this many rows, so a
# task stays the same whatever the table.  Only past MAX_SLOTS slots they grow.
ROWS_PER_SLOT = 100_000
MAX_SLOTS = 16_384
# Sample points in a slot.  The cut points are every so many-th of the sorted sample,
# which keeps the largest slot within twice the mean.
POINTS_PER_SLOT = 32
HASHES = 1 << 31
# The cut points are dealt into 2 ** CELL_STEPS cells.  A row finds its cell by a few halvings
# and its slot among the cell's in a broadcast join; both compare in generated code.  Halvings
# down to the slot are slower: too much code for the JVM to compile, or an array function.
CELL_STEPS = 8
QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5


def column_max(df: DataFrame, value: Column | str) -> Column:
    """Largest value of the whole frame, usable as a column of that frame."""
    return df.select(F.max(value)).scalar()


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """``value`` divided by its sum over all rows."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))


def _with_slot(
    df: DataFrame, order: Sequence[str], rows_per_slot: int, slots: int | None, slot: str
) -> DataFrame:
    """Number of the stretch of the sort order a row falls in.

    A row is a sample point when its hash is small, so the cut points depend on the
    rows only and recomputing a lost partition gives the same slots.  The sample
    holds at most about ``MAX_SLOTS * POINTS_PER_SLOT`` points, whatever the table.
    The slot is the number of cut points up to the row; the joined table of slots has
    at most about ``2 * MAX_SLOTS`` rows.
    """
    points = df.select(F.struct(*order).alias("point"))
    rows = points.agg(F.count(F.lit(1))).scalar()
    wanted = F.lit(slots) if slots else F.least(F.ceil(rows / rows_per_slot), F.lit(MAX_SLOTS))
    small = F.pmod(F.xxhash64("point"), F.lit(HASHES)) < wanted * (POINTS_PER_SLOT * HASHES) / rows
    every = F.sort_array(F.collect_list("point"))
    cuts = points.where(small).agg(
        F.filter(every, lambda _, i: (i + 1) % POINTS_PER_SLOT == 0).alias("cuts")
    )
    cuts = cuts.withColumn("per", F.ceil((F.size("cuts") + 1) / (1 << CELL_STEPS)).cast("int"))
    cells = cuts.select(F.filter("cuts", lambda _, i: (i + 1) % F.col("per") == 0)).scalar()
    number = F.explode(F.sequence(F.lit(0), F.size("cuts")))
    bounds = cuts.select("cuts", "per", number.alias(slot)).select(
        slot,
        F.floor(F.col(slot) / F.col("per")).cast("int").alias("_in"),
        F.get("cuts", F.col(slot) - 1).alias("_low"),
        F.get("cuts", F.col(slot)).alias("_high"),
    )
    placed = df.withColumns({"_cells": cells, "_point": F.struct(*order), "_cell": F.lit(0)})
    for step in [1 << i for i in reversed(range(CELL_STEPS))]:
        # Past the last cell `get` is null and the position stays.
        beyond = F.get("_cells", F.col("_cell") + step - 1) <= F.col("_point")
        further = F.when(beyond, F.col("_cell") + step).otherwise(F.col("_cell"))
        placed = placed.withColumn("_cell", further)
    inside = (
        (F.col("_cell") == F.col("_in"))
        & (F.col("_low").isNull() | (F.col("_low") <= F.col("_point")))
        & (F.col("_high").isNull() | (F.col("_point") < F.col("_high")))
    )
    return (
        placed.drop("_cells")
        .join(F.broadcast(bounds), inside)
        .drop("_cell", "_in", "_low", "_high", "_point")
    )


def with_position(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    weight: str | None = None,
    position: str = "position",
    total: str = "total",
    slots: int | None = None,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Running position of each row within its category, and the category total.

    Position is 1, 2, 3 … in the given order, or the running sum of ``weight``.
    ``order`` must identify a row within the category so that ties are split
    the same way every time.  A window group has about ``rows_per_slot`` rows, or
    the ``slots``-th part of all when that is given.
    """
    slot, before = "_slot", "_before"
    size = F.lit(1) if weight is None else F.col(weight)
    placed = _with_slot(df, [by, *order], rows_per_slot, slots, slot)

    # Only a category that crosses slots needs other slots' totals.  In a slot these are
    # its first and its last category at most, so the table is bounded by the slots.
    sizes = placed.groupBy(by, slot).agg(F.sum(size).alias("_size"))
    every = Window.partitionBy(by)
    earlier = every.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    crossing = sizes.select(
        F.col(by).alias("_by"),
        F.col(slot).alias("_at"),
        F.sum("_size").over(earlier).alias(before),
        F.sum("_size").over(every).alias("_all"),
        F.count(F.lit(1)).over(every).alias("_slots"),
    ).where("_slots > 1")

    within = Window.partitionBy(by, slot).orderBy(*order)
    up_to_here = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same_slot = F.col(by).eqNullSafe(F.col("_by")) & (F.col(slot) == F.col("_at"))
    return (
        placed.withColumns({position: F.sum(size).over(up_to_here), total: F.sum(size).over(whole)})
        .join(F.broadcast(crossing), same_slot, "left")
        .withColumn(position, F.col(position) + F.coalesce(F.col(before), F.lit(0)))
        .withColumn(total, F.when(F.col("_at").isNull(), F.col(total)).otherwise(F.col("_all")))
        .drop(slot, "_by", "_at", before, "_all", "_slots")
    )


def ecdf(
    df: DataFrame, by: str, value: str, key: str, name: str = "cdf", slots: int | None = None
) -> DataFrame:
    """Empirical distribution per category: i/n over ascending values.

    Equal values get consecutive positions, in the order of ``key``.
    """
    placed = with_position(df.select(by, value, key), by, [value, key], slots=slots)
    return placed.withColumn(name, F.col("position") / F.col("total")).drop("position", "total")


def value_counts(df: DataFrame, by: str, value: str) -> DataFrame:
    """Rows per category and value; equal values combine map-side."""
    return df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))


def quantiles(
    df: DataFrame,
    by: str,
    value: str,
    probabilities: dict[str, float],
    slots: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per category, one column per probability."""
    counts = with_position(
        value_counts(df, by, value), by, [value], weight="n", slots=slots
    )

    def at(rank: Column) -> Column:
        """Smallest value whose running count exceeds a zero-based rank."""
        return F.min(F.when(F.col("position") > rank, F.col(value)))

    ranks = {name: (F.col("total") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    bounds = []
    for name, rank in ranks.items():
        bounds.append(at(F.floor(rank)).alias(f"_{name}_low"))
        bounds.append(at(F.ceil(rank)).alias(f"_{name}_high"))
        bounds.append(F.max(rank - F.floor(rank)).alias(f"_{name}_part"))
    found = counts.groupBy(by).agg(*bounds)
    return found.select(
        by,
        *[
            (
                F.col(f"_{name}_low")
                + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * F.col(f"_{name}_part")
            ).alias(name)
            for name in ranks
        ],
    )


def quantiles_of_few(
    df: DataFrame, by: str, value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Exact quantiles when a category has a bounded number of distinct values.

    For measures such as a percentage rounded to two places (at most 10,001
    values).  Values are counted first, so the state per category is bounded
    by the distinct values and not by the rows.
    """
    found = value_counts(df, by, value).groupBy(by).agg(
        F.percentile(value, list(probabilities.values()), F.col("n")).alias("_q")
    )
    return found.select(
        by, *[F.element_at("_q", i + 1).alias(name) for i, name in enumerate(probabilities)]
    )


def quantiles_approx(
    df: DataFrame, by: str, value: str, probabilities: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Approximate quantiles in one pass, for very large exploratory input."""
    found = df.groupBy(by).agg(
        F.percentile_approx(value, list(probabilities.values()), accuracy).alias("_q")
    )
    return found.select(
        by, *[F.element_at("_q", i + 1).alias(name) for i, name in enumerate(probabilities)]
    )


def box_summary(
    df: DataFrame,
    by: str,
    value: str,
    few_values: bool = False,
    whisker: float = WHISKER,
    slots: int | None = None,
) -> DataFrame:
    """Box-plot numbers per category.

    Quartiles, mean, sample deviation, and the fences: the furthest values
    within ``whisker`` times the interquartile range of the quartiles.
    """
    df = df.select(by, value)
    names = dict(zip(("q1", "median", "q3"), QUARTILES))
    found = (
        quantiles_of_few(df, by, value, names)
        if few_values
        else quantiles(df, by, value, names, slots)
    )
    reach = (F.col("q3") - F.col("q1")) * whisker
    limits = found.withColumn("low", F.col("q1") - reach).withColumn("high", F.col("q3") + reach)
    inside = F.col(value).between(F.col("low"), F.col("high"))
    # Everything else comes from the same (category, value) counts, so the rows
    # are read once.  Moments are taken around the median to keep their digits.
    off = F.col(value) - F.col("median")
    sums = (
        value_counts(df, by, value)
        .join(limits, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.min(F.when(inside, F.col(value))).alias("lower_fence"),
            F.max(F.when(inside, F.col(value))).alias("upper_fence"),
            F.sum(off * F.col("n")).alias("_s1"),
            F.sum(off * off * F.col("n")).alias("_s2"),
        )
    )
    squares = F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("n")
    return (
        sums.withColumn("mean", F.col("median") + F.col("_s1") / F.col("n"))
        .withColumn("sd", F.sqrt(F.try_divide(F.greatest(squares, F.lit(0.0)), F.col("n") - 1)))
        .drop("_s1", "_s2")
    )


def histogram(
    df: DataFrame, by: str, value: str, low: float, high: float, bins: int
) -> DataFrame:
    """Rows per category and equal-width bin; bin 0 and ``bins + 1`` hold outliers."""
    bin_no = F.width_bucket(F.col(value), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(by, bin_no.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
