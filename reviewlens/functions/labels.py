"""Conditional labels, string predicates and display text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens.functions.measures import as_column

# Price tier labels and limits of the published gold tables.
TIER_FREE = "1. Free to Play"
TIER_LOW = "2. Indie Barato (<15€)"
TIER_MID = "3. Mid-range (15-50€)"
TIER_HIGH = "4. AAA (>=50€)"
TIERS = (TIER_FREE, TIER_LOW, TIER_MID, TIER_HIGH)
LOW_PRICE_BELOW = 15
HIGH_PRICE_FROM = 50

# Other labels of the published gold tables and charts.
POSITIVE_LABEL = "Positivo"
NEGATIVE_LABEL = "Negativo"
EARLY_LABEL = "Early Access"
RELEASED_LABEL = "Lanzamiento Completo"
AFTER_RELEASE_LABEL = "Post Lanzamiento"


def bucketize(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds; ``default`` when none does.

    A rule that evaluates to null does not hold, so rows with missing inputs
    fall through to the default.
    """
    first, *rest = rules
    label = F.when(first[0], first[1])
    for condition, text in rest:
        label = label.when(condition, text)
    return label if default is None else label.otherwise(default)


def price_tier(
    is_free: Column | str,
    price: Column | str,
    labels: Sequence[str] = TIERS,
    low_below: float = LOW_PRICE_BELOW,
    high_from: float = HIGH_PRICE_FROM,
) -> Column:
    """Four price tiers.  Free wins over any price; an unknown price is mid tier."""
    free, low, mid, high = labels
    price = as_column(price)
    return bucketize(
        [(as_column(is_free), free), (price < low_below, low), (price >= high_from, high)],
        default=mid,
    )


def two_way(condition: Column, yes: str, no: str) -> Column:
    """Two labels; an unknown condition takes the second."""
    return F.when(condition, yes).otherwise(no)


def flag_label(flag: Column | str, yes: str, no: str) -> Column:
    """Label of a boolean; a null flag stays null."""
    flag = as_column(flag)
    return F.when(flag, yes).when(~flag, no)


def non_empty(c: Column | str) -> Column:
    c = as_column(c)
    return c.isNotNull() & (c != "")


def contains_text(c: Column | str, query: str | None) -> Column:
    """Case-insensitive substring match; an empty query matches every row."""
    needle = (query or "").lower().strip()
    if not needle:
        return F.lit(True)
    return F.coalesce(F.contains(F.lower(as_column(c)), F.lit(needle)), F.lit(False))


def _fixed(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def compact_count(c: Column | str) -> Column:
    """``1.2M``, ``3.4K`` or the plain number."""
    n = as_column(c)
    return (
        F.when(n >= 1_000_000, F.concat(_fixed(n / 1e6, "0.0"), F.lit("M")))
        .when(n >= 1_000, F.concat(_fixed(n / 1e3, "0.0"), F.lit("K")))
        .otherwise(n.cast("string"))
    )


def axis_count(c: Column | str) -> Column:
    """Axis tick text: whole millions or whole thousands, truncated."""
    n = as_column(c)
    whole = lambda unit: F.floor(n / unit).cast("string")
    return F.when(n >= 1_000_000, F.concat(whole(1_000_000), F.lit("M"))).otherwise(
        F.concat(whole(1_000), F.lit("K"))
    )


def grouped_count(c: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(as_column(c), 0)


def percent_text(c: Column | str) -> Column:
    """One decimal and a percent sign."""
    return F.concat(_fixed(as_column(c), "0.0"), F.lit("%"))


def bar_text(percent: Column | str, n: Column | str) -> Column:
    """Bar label such as ``93.4% (1,234)``."""
    return F.concat(percent_text(percent), F.lit(" ("), grouped_count(n), F.lit(")"))
