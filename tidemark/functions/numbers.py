"""Exact money arithmetic.

Sums of doubles depend on the order of the rows. Records keep money as ``decimal(10,2)``.
For sums over large tables money is taken as whole cents instead: reading a double as
cents is several times cheaper than casting it to a decimal, and a ``decimal(18,0)`` sums
exactly into 28 digits, where a bigint could overflow. Only the finished figure becomes a
double again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, precision: int = 10) -> Column:
    return _column(c).cast(f"decimal({precision},2)")


def whole_cents(c: Column | str) -> Column:
    """A double with two decimals as a whole number of cents; null for NaN, infinities and what a
    bigint cannot hold, which sums then leave out."""
    return F.rint(_column(c) * 100).try_cast("bigint")


def summable(whole: Column) -> Column:
    """A whole number in the type that sums without overflow."""
    return whole.cast("decimal(18,0)")


def total(c: Column) -> Column:
    """Exact sum, as a double."""
    return F.sum(c).cast("double")


def mean(c: Column) -> Column:
    """Exact sum over count, as a double; null for a group without values."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, null when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def cents_value(c: Column | str) -> Column:
    """Cents as money, as a double."""
    return _column(c).cast("double") / F.lit(100)


def cents_total(c: Column) -> Column:
    """Exact sum of cents, as money."""
    return cents_value(F.sum(c))


def cents_mean(c: Column) -> Column:
    """Exact sum of cents over count, as money."""
    return F.try_divide(cents_total(c), F.count(c))


def cents_ratio(cents: Column, count: Column) -> Column:
    """A sum of cents over a count, as money; null when the count is 0."""
    return F.try_divide(cents_value(cents), count.cast("double"))


def cents_rounded(cents: Column, count: Column) -> Column:
    """The same rounded half up to a whole cent."""
    return cents_value(F.round(F.try_divide(cents, count), 0))
