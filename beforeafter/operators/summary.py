"""Gold summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.functions.numeric import ravg, rsum


def _lift_aggs(count_name: str, exact: bool = False) -> list:
    """Distinct customers, lift sums and the mean delta AOV.

    ``exact`` sums decimals, so results do not depend on summation order.
    """
    return [
        F.countDistinct("customer_id").alias(count_name),
        rsum("incremental_revenue", exact).alias("incremental_revenue"),
        rsum("incremental_transactions", exact).alias("incremental_transactions"),
        ravg("delta_aov", exact).alias("avg_delta_aov"),
    ]


def by_month(fact: DataFrame, exact: bool = False) -> DataFrame:
    """per normalised month: distinct customers, lift sums, mean delta AOV."""
    return (
        fact.groupBy(F.col("month_key_yyyymm").alias("month_id"))
        .agg(*_lift_aggs("exposed_customer_months", exact))
    )


def by_rfm(fact: DataFrame, rfm: DataFrame, exact: bool = False) -> DataFrame:
    """per normalised month and RFM segment; customers without an RFM row
    stay, with a NULL segment.  The join uses the stored ``month_id``."""
    r = rfm.select(
        F.col("customer_id").alias("__rc"), F.col("month_id").alias("__rm"), "rfm_segment"
    )
    f = fact.select("customer_id", "month_id", "month_key_yyyymm", "incremental_revenue",
                    "incremental_transactions", "delta_aov")
    j = f.join(r, (f.customer_id == r.__rc) & (f.month_id == r.__rm), "left")
    return j.groupBy(F.col("month_key_yyyymm").alias("month_id"), "rfm_segment").agg(
        *_lift_aggs("customers", exact)
    )


def by_flags(fact: DataFrame, exact: bool = False) -> DataFrame:
    """per normalised month, active flag and high-value flag."""
    return fact.groupBy(
        F.col("month_key_yyyymm").alias("month_id"), "is_active", "is_high_value"
    ).agg(*_lift_aggs("customers", exact))
