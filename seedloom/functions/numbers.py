"""Rounding that agrees with Python's ``round`` on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exactly(value: Column, digits: int) -> Column:
    """Nearest ``digits``-place decimal of the double's exact binary value, halves to even.

    Spark's ``round`` decides on the shortest decimal text of a double, Python on
    the double itself: the double written 0.7105 is a hair below it and goes down.
    ``format_number`` looks at the exact value as Python does, but only for values
    of at least one unit in the last place. It names ``value`` only once, which
    keeps the generated code small.
    """
    return F.replace(F.format_number(value, digits), F.lit(",")).cast("double")


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded; null where there is nothing to divide by."""
    value = part.cast("double") / whole.cast("double")
    unit = 10.0**-digits
    half = unit / 2
    up = value >= half if round(half, digits) > 0 else value > half
    tiny = F.when(up, F.lit(unit)).otherwise(F.lit(0.0))
    rounded = F.when(value < unit, tiny).otherwise(round_exactly(value, digits))
    return F.when(whole > 0, rounded)
