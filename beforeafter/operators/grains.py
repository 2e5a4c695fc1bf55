"""All summaries and measures of the fact in one pass.

The three gold summaries, the measures at each of their grains and the
reconciliation differ only in their grouping.  ``rollup`` reads the fact (joined
with the segments) once and returns one row per group of every grain; the
summaries are filters of that small frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.functions.numeric import exact_sum
from beforeafter.operators.measures import MEASURES
from beforeafter.session import spread

#: Grain -> the columns that group it.
GRAINS: dict[str, list[str]] = {
    "total": [],
    "month": ["month_id"],
    "flags": ["is_active", "is_high_value"],
    "month_flags": ["month_id", "is_active", "is_high_value"],
    "segment": ["rfm_segment"],
    "month_segment": ["month_id", "rfm_segment"],
}
KEYS = ["month_id", "rfm_segment", "is_active", "is_high_value"]


def rollup(fact: DataFrame, rfm: DataFrame, exact: bool = False) -> DataFrame:
    """One row per grain and group: grain, month_id (normalised), rfm_segment,
    is_active, is_high_value (null where the grain does not group by them),
    row_count, customers (distinct) and the five measures.

    Rows without an RFM row keep a null segment; null keys are groups; an empty
    fact gives no rows, also for the total.  ``exact`` sums decimals.

    Rows move to their customer once.  There a row is repeated for each grain and
    reduced to one row per customer and group, still in place, so that distinct
    customers are a plain count, which combines before the last, small shuffle;
    no distinct aggregate, and no group is held in one task.
    """
    seg = rfm.select(F.col("customer_id").alias("__rc"), F.col("month_id").alias("__rm"), "rfm_segment")
    cols = [m.column for m in MEASURES.values()]
    j = fact.join(seg, (fact["customer_id"] == seg["__rc"]) & (fact["month_id"] == seg["__rm"]), "left")
    rows = j.select(
        "customer_id", F.col("month_key_yyyymm").alias("month_id"), "rfm_segment", "is_active", "is_high_value", *cols
    )
    rows = spread(rows, fact.count(), "customer_id")
    group = [
        F.struct(
            F.lit(grain).alias("grain"),
            *[(F.col(k) if k in by else F.lit(None).cast(rows.schema[k].dataType)).alias(k) for k in KEYS],
        )
        for grain, by in GRAINS.items()
    ]
    rows = rows.select("customer_id", *cols, F.explode(F.array(*group)).alias("g"))
    rows = rows.select("customer_id", *cols, "g.*")
    per_customer = rows.groupBy("customer_id", "grain", *KEYS).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[(exact_sum(c) if exact else F.sum(c)).alias(f"__s_{c}") for c in cols],
        *[F.count(c).alias(f"__n_{c}") for c in cols],
    )
    total = per_customer.groupBy("grain", *KEYS).agg(
        F.sum("__rows").alias("row_count"),
        F.count("customer_id").alias("customers"),
        *[F.sum(f"__s_{c}").cast("double").alias(f"__s_{c}") for c in cols],
        *[F.sum(f"__n_{c}").alias(f"__n_{c}") for c in cols],
    )
    values = [
        (F.col(f"__s_{m.column}") if m.kind == "sum" else F.try_divide(f"__s_{m.column}", f"__n_{m.column}")).alias(m.alias)
        for m in MEASURES.values()
    ]
    return total.select("grain", *KEYS, "row_count", "customers", *values)


def _summary(rolled: DataFrame, grain: str, count_name: str = "customers") -> DataFrame:
    return rolled.where(F.col("grain") == grain).select(
        *GRAINS[grain],
        F.col("customers").alias(count_name),
        "incremental_revenue",
        "incremental_transactions",
        F.col("average_delta_aov").alias("avg_delta_aov"),
    )


def by_month(rolled: DataFrame) -> DataFrame:
    """F1 from ``rollup``."""
    return _summary(rolled, "month", "exposed_customer_months")


def by_rfm(rolled: DataFrame) -> DataFrame:
    """F2 from ``rollup``."""
    return _summary(rolled, "month_segment")


def by_flags(rolled: DataFrame) -> DataFrame:
    """F3 from ``rollup``."""
    return _summary(rolled, "month_flags")


def measures_at(rolled: DataFrame, grain: str) -> DataFrame:
    """I1-I5 at one grain from ``rollup``."""
    return rolled.where(F.col("grain") == grain).select(*GRAINS[grain], *[m.alias for m in MEASURES.values()])
