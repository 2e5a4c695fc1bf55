"""Text helpers for generated summaries (H1-H3), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NA = "N/A"


def _bad(c: Column) -> Column:
    d = c.cast("double")
    return d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def fmt(c: Column, decimals: int = 0) -> Column:
    """H1: thousands separators and fixed decimals; NULL, NaN, infinite -> "N/A"."""
    return F.when(_bad(c), F.lit(NA)).otherwise(F.format_number(c.cast("double"), decimals))


def direction(c: Column) -> Column:
    """H2: positive / negative / neutral; NULL or NaN -> unknown."""
    d = c.cast("double")
    return (
        F.when(d.isNull() | F.isnan(d), "unknown")
        .when(d > 0, "positive")
        .when(d < 0, "negative")
        .otherwise("neutral")
    )


def safe(c: Column) -> Column:
    """H3: NULL, NaN and infinite -> 0.0."""
    return F.when(_bad(c), F.lit(0.0)).otherwise(c.cast("double"))


def pct(part: Column, whole: Column, decimals: int = 1) -> Column:
    """``part / whole`` as a percentage text, "N/A" when ``whole`` is 0 or NULL."""
    return F.when(
        whole.isNull() | (whole == 0), F.lit(NA)
    ).otherwise(F.concat(fmt(part.cast("double") / whole.cast("double") * 100, decimals), F.lit("%")))
