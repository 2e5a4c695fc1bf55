"""Named measures evaluated at any grain.

A measure is a name, an aggregate over the customer-month fact, a display
folder and a display format.  ``evaluate`` is one ``groupBy(by).agg`` (a
global aggregate when ``by`` is empty), so it runs at the visual's grain
without materialising anything else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.functions.numeric import ravg, rsum
from beforeafter.functions.text import fmt


@dataclass(frozen=True)
class Measure:
    name: str
    column: str
    kind: str  # "sum" or "avg"
    folder: str
    format: str
    alias: str

    def agg(self, exact: bool) -> Column:
        f = rsum if self.kind == "sum" else ravg
        return f(self.column, exact).alias(self.alias)


# The published measures (name, column, aggregate, folder, format).
MEASURES: dict[str, Measure] = {
    m.name: m
    for m in [
        Measure("Incremental Revenue", "incremental_revenue", "sum", "CEO | Incrementality", "#,0.00", "incremental_revenue"),
        Measure("Incremental Transactions", "incremental_transactions", "sum", "CEO | Incrementality", "#,0", "incremental_transactions"),
        Measure("Average Delta AOV", "delta_aov", "avg", "CEO | Incrementality", "#,0.00", "average_delta_aov"),
        Measure("Pre Revenue per Day", "pre_rev_per_day", "avg", "Analyst | Baseline", "#,0.00", "pre_revenue_per_day"),
        Measure("Post Revenue per Day", "post_rev_per_day", "avg", "Analyst | Impact", "#,0.00", "post_revenue_per_day"),
    ]
}
NAMES = list(MEASURES)


def evaluate(fact: DataFrame, names: list[str], by: list[str] | None = None, exact: bool = False) -> DataFrame:
    """The named measures per group of ``by`` (whole table when empty)."""
    aggs = [MEASURES[n].agg(exact) for n in names]
    return fact.groupBy(*(by or [])).agg(*aggs)


def _decimals(fmt_string: str) -> int:
    return len(fmt_string.split(".")[1]) if "." in fmt_string else 0


def formatted(df: DataFrame, names: list[str]) -> DataFrame:
    """Add ``<alias>_text`` display columns using each measure's format."""
    out = df
    for n in names:
        m = MEASURES[n]
        out = out.withColumn(f"{m.alias}_text", fmt(F.col(m.alias), _decimals(m.format)))
    return out


def with_segment(fact: DataFrame, rfm: DataFrame) -> DataFrame:
    """The fact with the segment of its customer and stored month; rows without an
    RFM row read "Unknown"."""
    r = rfm.select(F.col("customer_id").alias("__rc"), F.col("month_id").alias("__rm"), "rfm_segment")
    j = fact.join(r, (fact["customer_id"] == r["__rc"]) & (fact["month_id"] == r["__rm"]), "left")
    return j.withColumn("rfm_segment", F.coalesce("rfm_segment", F.lit("Unknown"))).drop("__rc", "__rm")
