"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """Half-up rounding of the decimal value: 11884.405 gives 11884.41 even where the nearest binary
    number lies just below."""
    return F.round(x.cast("decimal(28,8)"), digits).cast("double")


def round_half_even(x: Column, digits: int) -> Column:
    return F.bround(x.cast("decimal(28,8)"), digits).cast("double")
