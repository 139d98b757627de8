"""Scalar feature expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contract import ColumnOrName, col, ratio


def weighted_sum(cols: Sequence[ColumnOrName], weights: Sequence[float]) -> Column:
    """``w1*a + w2*b + ...``; missing if any input is missing."""
    total = None
    for c, w in zip(cols, weights):
        term = col(c) * w
        total = term if total is None else total + term
    return total


def smoothed_ratio(num: ColumnOrName, den: ColumnOrName, add: float = 1.0) -> Column:
    """``a / (b + 1)``."""
    return ratio(num, col(den) + add)


def euclid(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``(a**2 + b**2) ** 0.5`` (finite for finite inputs, so the
    reference's inf -> 0 step is a no-op)."""
    return F.sqrt(col(a) * col(a) + col(b) * col(b))


def log1p(c: ColumnOrName) -> Column:
    return F.log1p(col(c))


def expm1(c: ColumnOrName) -> Column:
    return F.expm1(col(c))


def guarded_log(c: ColumnOrName) -> Column:
    """``ln(x)`` if x > 0 else 0; a missing value gives 0."""
    x = col(c)
    return F.when(x > 0, F.ln(x)).otherwise(F.lit(0.0))


def child_or(age: ColumnOrName, other: ColumnOrName, below: float = 10) -> Column:
    """``'child'`` when age < 10, else the other column (a missing age
    compares false, so it falls through to the other column)."""
    return F.when(col(age) < below, F.lit("child")).otherwise(col(other))


def indicator_sum(cols: Sequence[ColumnOrName]) -> Column:
    """sum of 0/1 indicator columns."""
    total = None
    for c in cols:
        total = col(c) if total is None else total + col(c)
    return total


def round1(c: ColumnOrName) -> Column:
    """rounding to one decimal."""
    return F.round(col(c), 1)
