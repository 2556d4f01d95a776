"""Rounding and ratios that give the same digits whatever the evaluation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Up to this size a double holds the eighth decimal's units exactly.
COUNTED_SIZE = 4e7


def rounded(value: Column, places: int) -> Column:
    """Half-up rounding of a float, taken on its eight decimals rather than its binary value.

    The eight decimals are those of SQL's ``CAST(x AS DECIMAL(28,8))``: the nearest whole number of
    x times 10^8, a product of doubles. Spark's own cast rounds the shortest text of x instead,
    which differs where the ninth decimal is the last one and a five. They are counted as whole
    numbers; only large values are rounded by their text.
    """
    x = value.cast("double")
    # Half units are counted, since adding a half to the product could carry it to the next number.
    units = F.shiftright(F.floor(F.abs(x) * F.lit(2e8)) + 1, 1)
    if places < 8:
        units = F.floor((units + F.lit(5 * 10 ** (7 - places))) / F.lit(10.0 ** (8 - places)))
    exact = F.signum(x) * units / F.lit(10.0 ** places) + F.lit(0.0)
    return F.when(F.abs(x) < COUNTED_SIZE, exact).otherwise(F.round(x, places))


def money(total: Column, places: int = 2) -> Column:
    """Round an exact decimal total once, at the end."""
    return F.round(total, places).cast("double")


def mean(value: Column) -> Column:
    """Mean whose sum is exact when the input is an integer or a decimal."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    return rounded(F.try_divide(F.lit(1e2) * part.cast("double"), whole), places)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clamp(value: Column, low, high) -> Column:
    """Limit a value to a range; a missing value stays missing."""
    limited = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), limited)
