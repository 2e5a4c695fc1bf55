"""Month key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A month key has six digits (yyyyMM) or eight (yyyyMMdd); any
# other number is no key.
SIX_DIGITS, EIGHT_DIGITS = (100_000, 999_999), (10_000_000, 99_999_999)


def _year_month(month_id: Column) -> Column:
    """The leading yyyyMM of a key of either length as a whole number."""
    n = month_id.try_cast("long")
    days = F.when(n.between(*EIGHT_DIGITS), 100).when(n.between(*SIX_DIGITS), 1)
    return F.floor(n / days).cast("int")


def month_key(month_id: Column) -> Column:
    """The month of a key of either length, NULL for anything else."""
    return _year_month(month_id)


def month_end(month_id: Column) -> Column:
    """Last day of the key's month; NULL for a key without a calendar day."""
    ym = _year_month(month_id)
    last = F.last_day(F.make_date(F.floor(ym / 100).cast("int"), F.when((ym % 100).between(1, 12), ym % 100), F.lit(1)))
    n = month_id.try_cast("long")
    return F.when(n.between(*SIX_DIGITS) | (n % 100).between(F.lit(1), F.dayofmonth(last)), last)


def month_norm(month_id: Column) -> Column:
    """G1: text month key; a missing month reads "Unknown"."""
    return F.coalesce(month_id.cast("string"), F.lit("Unknown"))


def month_sort_key(month_norm_col: Column) -> Column:
    """``YYYY-MM`` sorts as ``YYYYMM``; other text sorts as is."""
    return F.when(
        (F.length(month_norm_col) == 7) & (F.substring(month_norm_col, 5, 1) == "-"),
        F.regexp_replace(month_norm_col, "-", ""),
    ).otherwise(month_norm_col)
