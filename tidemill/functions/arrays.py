"""Element-wise arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(a: Column) -> Column:
    return a.cast("array<double>")


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def divide(a: Column, b: Column) -> Column:
    """Null where the divisor is zero."""
    return F.zip_with(a, b, lambda x, y: F.try_divide(x, y))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column) -> Column:
    return total(a) / F.size(a)


def std(a: Column) -> Column:
    """Population standard deviation."""
    m = mean(a)
    return F.sqrt(total(F.transform(a, lambda x: (x - m) * (x - m))) / F.size(a))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def distance(a: Column, b: Column) -> Column:
    return norm(subtract(a, b))


def nearest_distance(point: Column, centers: list[list[float]]) -> Column:
    """Distance to the nearest of a few centres, which travel as literals in the plan."""
    dists = [distance(point, F.array(*[F.lit(float(v)) for v in c])) for c in centers]
    return F.least(*dists) if len(dists) > 1 else dists[0]


def append_item(a: Column, item: Column) -> Column:
    return F.array_append(a, item)


def take_slice(a: Column, start: int, length: int) -> Column:
    return F.slice(a, start, length)
