"""Double arithmetic whose last bit matters, as DuckDB does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _halves(a: Column) -> tuple[Column, Column]:
    """a as the sum of two doubles of half its digits (Veltkamp)."""
    c = a * 134217729.0
    high = c - (c - a)
    return high, a - high


def fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c, where the product isn't rounded before c is added (Dekker, Knuth). Beyond about 1e300 it is, and infinities and NaN are as usual."""
    (a1, a2), (b1, b2) = _halves(a), _halves(b)
    p = a * b
    s = p + c
    d = s - p
    rest = ((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2
    return s + F.nanvl(((p - (s - d)) + (c - d)) + rest, F.lit(0.0))


def rounded(x: Column, digits: int) -> Column:
    """x times a power of ten, rounded half away from zero, over that power. F.round goes by x's shortest decimal digits, so that 0.031955, of which
    the product is 3195.4999999999995, differs."""
    r = F.round(x * 10.0**digits) / 10.0**digits
    return F.when(F.abs(r) == float("inf"), x).otherwise(r)
