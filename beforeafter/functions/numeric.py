"""Numeric helpers: order-independent sums and means, coercion of text to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: Decimals that an exact sum keeps of every row.
ROW_DECIMALS = 6


def exact_sum(col: str | Column) -> Column:
    """Sum of the values rounded to ``ROW_DECIMALS`` decimals, as DECIMAL(38, 6).

    A double sum depends on the order of addition in its last bits; a decimal sum
    does not, so the result is the same on every partitioning.
    """
    return F.sum(_c(col).cast(f"decimal(28,{ROW_DECIMALS})"))


def rsum(col: str | Column, exact: bool = False) -> Column:
    """``sum`` as a double; with ``exact`` from :func:`exact_sum`."""
    return exact_sum(col).cast("double") if exact else F.sum(_c(col))


def ravg(col: str | Column, exact: bool = False) -> Column:
    """``avg``; with ``exact`` the exact sum over the count."""
    c = _c(col)
    return exact_sum(c).cast("double") / F.count(c) if exact else F.avg(c)


def to_number(col: str | Column) -> Column:
    """Text or number to double; anything that does not parse is 0.0."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(0.0))
