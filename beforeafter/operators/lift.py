"""Customer-month lift fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.config import DEFAULT, LiftConfig
from beforeafter.functions.months import month_key


def base(pre_post_df: DataFrame, customers: DataFrame, cfg: LiftConfig = DEFAULT) -> DataFrame:
    """Attach the customer flags (inner join: unknown customers drop out)
    and the window lengths."""
    c = customers.select("customer_id", "is_active", "is_high_value")
    x = pre_post_df.select(
        "customer_id",
        "month_id",
        "anchor_exposure_date",
        "pre_txn_cnt",
        "pre_revenue",
        "pre_active_days",
        "post_txn_cnt",
        "post_revenue",
        "post_active_days",
    )
    return x.join(c, "customer_id", "inner").select(
        "customer_id",
        "month_id",
        "anchor_exposure_date",
        "is_active",
        "is_high_value",
        "pre_txn_cnt",
        "pre_revenue",
        "pre_active_days",
        "post_txn_cnt",
        "post_revenue",
        "post_active_days",
        F.lit(cfg.pre_days).alias("pre_days"),
        F.lit(cfg.post_days).alias("post_days"),
    )


def _per_day(x: Column, days: Column) -> Column:
    return F.when(days > 0, x / days).otherwise(F.lit(0.0))


def rates(df: DataFrame) -> DataFrame:
    """D3: per-day revenue and transactions, active-day frequency and average
    order value (0.0 when the window has no transaction)."""
    pre, post = F.col("pre_days"), F.col("post_days")
    out = df.select(
        "*",
        _per_day(F.col("pre_revenue"), pre).alias("pre_rev_per_day"),
        _per_day(F.col("post_revenue"), post).alias("post_rev_per_day"),
        _per_day(F.col("pre_txn_cnt"), pre).alias("pre_txn_per_day"),
        _per_day(F.col("post_txn_cnt"), post).alias("post_txn_per_day"),
        _per_day(F.col("pre_active_days"), pre).alias("pre_freq"),
        _per_day(F.col("post_active_days"), post).alias("post_freq"),
    )
    return out.select(
        "*",
        F.when(F.col("pre_txn_per_day") > 0, F.col("pre_rev_per_day") / F.col("pre_txn_per_day"))
        .otherwise(F.lit(0.0))
        .alias("pre_aov"),
        F.when(F.col("post_txn_per_day") > 0, F.col("post_rev_per_day") / F.col("post_txn_per_day"))
        .otherwise(F.lit(0.0))
        .alias("post_aov"),
    )


def deltas(df: DataFrame, cfg: LiftConfig = DEFAULT) -> DataFrame:
    """Differences of the per-day rates scaled to the POST window length."""
    k = F.lit(float(cfg.post_days))
    return df.select(
        "*",
        ((F.col("post_rev_per_day") - F.col("pre_rev_per_day")) * k).alias("incremental_revenue"),
        ((F.col("post_txn_per_day") - F.col("pre_txn_per_day")) * k).alias("incremental_transactions"),
        ((F.col("post_freq") - F.col("pre_freq")) * k).alias("incremental_freq_points"),
        (F.col("post_aov") - F.col("pre_aov")).alias("delta_aov"),
    )


FACT_COLUMNS = [
    "customer_id",
    "month_id",
    "month_key_yyyymm",
    "anchor_exposure_date",
    "is_active",
    "is_high_value",
    "pre_txn_cnt",
    "pre_revenue",
    "pre_active_days",
    "post_txn_cnt",
    "post_revenue",
    "post_active_days",
    "pre_rev_per_day",
    "post_rev_per_day",
    "pre_txn_per_day",
    "post_txn_per_day",
    "pre_freq",
    "post_freq",
    "pre_aov",
    "post_aov",
    "incremental_revenue",
    "incremental_transactions",
    "incremental_freq_points",
    "delta_aov",
]


def fact(pre_post_df: DataFrame, customers: DataFrame, cfg: LiftConfig = DEFAULT) -> DataFrame:
    """The customer-month lift fact."""
    b = base(pre_post_df, customers, cfg).withColumn("month_key_yyyymm", month_key(F.col("month_id")))
    return deltas(rates(b), cfg).select(*FACT_COLUMNS)
