"""Many-to-many bridges: categories and owners of items.

The fact never meets a bridge.  It is aggregated to items first, and the item
rows are joined to the bridge and summed, which gives the same counts and sums
as fanning every review out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An item with more labels than this is heavy: its labels are spread over SALTS slots
# and its row is repeated for each.  All other items are joined as they are.
HEAVY_LABELS = 10_000
SALTS = 64


def item_labels(bridge: DataFrame, dimension: DataFrame, on: str, label: str) -> DataFrame:
    """``(item_id, label, links)``: the bridge with labels, equal pairs merged.

    ``links`` counts how often a pair occurs, so duplicate bridge rows and
    same-named members keep counting as often as they occur while a heavily
    repeated pair is combined map-side before it is shuffled.
    """
    return (
        bridge.join(dimension.select(on, label), on)
        .groupBy("item_id", label)
        .agg(F.count(F.lit(1)).alias("links"))
    )


def join_labels(
    summary: DataFrame,
    labels: DataFrame,
    salts: int = 1,
    heavy: int = HEAVY_LABELS,
) -> DataFrame:
    """Item rows ⋈ item labels.

    For a small dimension one slot is enough: after equal pairs are merged an item
    has at most one row per label.  With ``salts`` above one, items that have more
    than ``heavy`` labels are split: their labels go to slots by their hash, their
    item row is repeated per slot.  The heavy items are few, at most one in ``heavy``
    bridge rows, and are counted map-side first.
    """
    if salts == 1:
        return summary.join(labels, "item_id")
    slot, flag = "_slot", "_heavy"
    names = [c for c in labels.columns if c not in ("item_id", "links")]
    split = labels.groupBy("item_id").agg(F.count(F.lit(1)).alias(flag)).filter(F.col(flag) > heavy)
    own = F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int")
    spread = labels.join(split, "item_id", "left").select(
        *labels.columns, F.when(F.col(flag).isNotNull(), own).otherwise(0).alias(slot)
    )
    every = F.sequence(F.lit(0), F.when(F.col(flag).isNotNull(), F.lit(salts - 1)).otherwise(0))
    repeated = summary.join(split, "item_id", "left").select(*summary.columns, F.explode(every).alias(slot))
    return repeated.join(spread, ["item_id", slot]).drop(slot)


def sum_by_label(
    summary: DataFrame,
    labels: DataFrame,
    label: str,
    sums: list[str],
    keys: tuple[str, ...] = (),
    salts: int = 1,
    heavy: int = HEAVY_LABELS,
) -> DataFrame:
    """Additive measures per label (and further keys of the summary).

    ``items`` is the number of summary rows of the label: the number of
    distinct items when the summary has one row per item.
    """
    joined = join_labels(summary.select("item_id", *keys, *sums), labels, salts, heavy)
    return joined.groupBy(label, *keys).agg(
        F.count(F.lit(1)).alias("items"),
        *[F.sum(F.col(c) * F.col("links")).alias(c) for c in sums],
    )


def primary_member(bridge: DataFrame, dimension: DataFrame, on: str, label: str) -> DataFrame:
    """Label of each item's smallest member id; null when the dimension lacks that id."""
    first = bridge.groupBy("item_id").agg(F.min(on).alias(on))
    return first.join(dimension.select(on, label), on, "left").select("item_id", label)
