"""Column expressions for cleaning, flags and scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scorecard constants: points to double the odds, and points at even odds.
POINTS_TO_DOUBLE = 40
BASE_POINTS = 1130


def threshold_flag(value: Column, threshold: float) -> Column:
    """1 from the threshold on, else 0; null counts as below."""
    return F.when(value >= threshold, 1).otherwise(0)


def coerce_number(text: Column) -> Column:
    """Number in a text, null where it is none."""
    return text.try_cast("double")


def cap(value: Column, low: float, high: float) -> Column:
    """Clip to a range; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def scorecard_points(
    probability: Column, to_double: float = POINTS_TO_DOUBLE, base: float = BASE_POINTS
) -> Column:
    """Whole points from a probability of default, higher for lower risk; null at 0 and 1."""
    p = F.when((probability > 0) & (probability < 1), probability)
    return (F.log((1 - p) / p) * to_double / math.log(2) + base).cast("int")


def hash_order(key: Column, seed: int) -> Column:
    """Evenly spread number below 2**32, set by key and seed alone."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def first_of_month(date: Column) -> Column:
    return F.trunc(date, "month")


def percent(share_of_100: Column, digits: int = 2) -> Column:
    """Percentage text, for presentation, ties to even; null stays null."""
    value = F.bround(share_of_100, digits)
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f%%", value))


def first_present(columns: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """The wanted names that exist, in the wanted order."""
    have = set(columns)
    return [c for c in wanted if c in have]
