"""Small vectors as array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound_to(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once for the row."""
    return F.transform(F.array(value), use)[0]


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(v, lambda x: x * x)))


def scaled(v: Column, k: Column) -> Column:
    return F.transform(v, lambda x: x * k)


def l1(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def finite(v: Column) -> Column:
    return ~F.exists(v, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
