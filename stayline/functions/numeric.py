"""Rounding that gives the same digits whichever engine computes it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int) -> Column:
    """Half-up rounding of a double; the decimal step turns 83.33499999 back into the tie it was."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """``part * scale / whole``, null where the whole is null or zero."""
    return fixed(F.try_divide(part.cast("double") * F.lit(float(scale)), whole.cast("double")), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part, whole, digits, 100)


def mean(value: Column | str, digits: int, scale: int = 1) -> Column:
    """Average of an exact column, from its exact sum: the order of the rows cannot matter."""
    return ratio(F.sum(value), F.count(value), digits, scale)


def count_if(condition: Column) -> Column:
    """``SUM(CASE WHEN condition THEN 1 ELSE 0 END)``: null, not 0, over no rows."""
    return F.sum(F.when(condition, 1).otherwise(0))
