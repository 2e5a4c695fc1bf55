"""Validation checks.

Each check is an aggregate that returns a small frame (one row, or one row
per month or column) with the counts behind it and a ``passed`` flag; the
offending rows themselves are available from the ``*_rows`` helpers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.functions.months import month_key, month_norm
from beforeafter.functions.numeric import rsum
from beforeafter.operators.ranking import bounded
from beforeafter.operators.rfm import MAX_MONTHS


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys, keys occurring more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("__n") > 1, 1)).alias("duplicate_keys"),
    ).withColumn("passed", F.col("duplicate_keys") == 0)


def duplicate_exposures(exposures: DataFrame) -> DataFrame:
    """Anchors with more than one contact on the anchor day, and
    contact ids used more than once."""
    per_day = exposures.groupBy("customer_id", "month_id", "exposure_date").agg(F.count(F.lit(1)).alias("__n"))
    per_anchor = per_day.groupBy("customer_id", "month_id").agg(
        F.min_by("__n", "exposure_date").alias("__on_anchor")
    )
    a = per_anchor.agg(
        F.count(F.lit(1)).alias("anchors"),
        F.count(F.when(F.col("__on_anchor") > 1, 1)).alias("anchors_with_duplicates"),
        F.max("__on_anchor").cast("long").alias("max_contacts_on_anchor_day"),
    )
    ids = exposures.groupBy("exposure_id").agg(F.count(F.lit(1)).alias("__n")).agg(
        F.count(F.when(F.col("__n") > 1, 1)).alias("duplicate_exposure_ids")
    )
    return a.crossJoin(ids).withColumn(
        "passed", (F.col("anchors_with_duplicates") == 0) & (F.col("duplicate_exposure_ids") == 0)
    )


def numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, non-null values and those that do not parse as numbers."""
    aggs = []
    for c in cols:
        v = F.col(c)
        aggs += [
            F.count(v).alias(f"{c}__values"),
            F.count(F.when(v.isNotNull() & v.cast("string").try_cast("double").isNull(), 1)).alias(f"{c}__bad"),
        ]
    wide = df.agg(*aggs)
    parts = [
        wide.select(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__values").alias("value_count"),
            F.col(f"{c}__bad").alias("non_numeric"),
        )
        for c in cols
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("non_numeric") == 0)


def reconcile(by_month: DataFrame, by_rfm: DataFrame, by_flags: DataFrame, exact: bool = True, tol: float = 1e-3) -> DataFrame:
    """Per month, customers, revenue and transactions of the month summary
    against the sums over segments and over flags (full outer join, so a month
    missing from one summary shows up)."""

    def roll(df: DataFrame, cust: str, tag: str) -> DataFrame:
        return df.groupBy("month_id").agg(
            F.sum(cust).cast("long").alias(f"customers_{tag}"),
            rsum("incremental_revenue", exact).alias(f"revenue_{tag}"),
            rsum("incremental_transactions", exact).alias(f"transactions_{tag}"),
        )

    m = roll(by_month, "exposed_customer_months", "month")
    r = roll(by_rfm, "customers", "rfm")
    f = roll(by_flags, "customers", "flags")
    j = m.join(r, "month_id", "full_outer").join(f, "month_id", "full_outer")

    def close(a: str, b: str) -> F.Column:
        return F.coalesce(F.abs(F.col(a) - F.col(b)) <= tol, F.lit(False))

    ok = (
        close("customers_month", "customers_rfm")
        & close("customers_month", "customers_flags")
        & close("revenue_month", "revenue_rfm")
        & close("revenue_month", "revenue_flags")
        & close("transactions_month", "transactions_rfm")
        & close("transactions_month", "transactions_flags")
    )
    return j.withColumn("passed", ok)


def windows(pre_post_df: DataFrame, pre_days: int, post_days: int) -> DataFrame:
    """Window lengths, window placement around the anchor, anchor in its month."""
    a = F.col("anchor_exposure_date")
    bad_pre = (F.datediff("pre_end", "pre_start") + 1 != pre_days) | (F.date_add("pre_end", 1) != a)
    bad_post = (F.datediff("post_end", "post_start") + 1 != post_days) | (F.col("post_start") != a)
    mism = a.isNull() | (
        F.date_format(a, "yyyyMM").cast("int") != F.coalesce(month_key(F.col("month_id")), F.lit(-1))
    )
    out = pre_post_df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(bad_pre, 1)).alias("bad_pre_window"),
        F.count(F.when(bad_post, 1)).alias("bad_post_window"),
        F.count(F.when(mism, 1)).alias("anchor_month_mismatch"),
    )
    return out.withColumn(
        "passed",
        (F.col("bad_pre_window") == 0) & (F.col("bad_post_window") == 0) & (F.col("anchor_month_mismatch") == 0),
    )


def no_activity(fact: DataFrame) -> DataFrame:
    """Per month, rows with no PRE purchase, no POST purchase, neither."""
    m = fact.withColumn("month_id_norm", month_norm(F.col("month_id")))
    pre0, post0 = F.col("pre_txn_cnt") == 0, F.col("post_txn_cnt") == 0
    return m.groupBy("month_id_norm").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(pre0, 1)).alias("no_pre"),
        F.count(F.when(post0, 1)).alias("no_post"),
        F.count(F.when(pre0 & post0, 1)).alias("no_pre_no_post"),
    )


def zero_shares(fact: DataFrame) -> DataFrame:
    """Per month, share of rows with zero PRE revenue and zero POST revenue."""
    m = fact.withColumn("month_id_norm", month_norm(F.col("month_id")))
    g = m.groupBy("month_id_norm").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(F.col("pre_revenue") == 0, 1)).alias("zero_pre"),
        F.count(F.when(F.col("post_revenue") == 0, 1)).alias("zero_post"),
    )
    return g.select(
        "*",
        (F.col("zero_pre") / F.col("row_count")).alias("zero_pre_share"),
        (F.col("zero_post") / F.col("row_count")).alias("zero_post_share"),
    )


def without_zero_months(fact: DataFrame, most: float) -> DataFrame:
    """The fact without months in which the share of rows with zero PRE or zero
    POST revenue is above ``most``."""
    shares = zero_shares(fact)
    sparse = shares.where((F.col("zero_pre_share") > most) | (F.col("zero_post_share") > most))
    named = fact.withColumn("__m", month_norm(F.col("month_id")))
    months = bounded(sparse.select(F.col("month_id_norm").alias("__m")), MAX_MONTHS, "months")
    return named.join(months, "__m", "left_anti").drop("__m")


def final_gate(total_grid: DataFrame, segments: DataFrame) -> DataFrame:
    """One row before results go out: whether the direction of the total lift is the
    same for every window length, and the segments whose lift is negative, by name.

    ``total_grid`` has incremental_revenue per window pair, ``segments`` rfm_segment
    and incremental_revenue, one row each.
    """
    r = F.col("incremental_revenue")
    direction = total_grid.agg(
        F.count(F.when(r > 0, 1)).alias("grid_positive"), F.count(F.when(r < 0, 1)).alias("grid_negative")
    )
    names = F.sort_array(F.collect_list(F.when(r < 0, F.col("rfm_segment"))))
    listed = segments.agg(F.array_join(names, ", ").alias("negative_segments"), F.count(F.when(r < 0, 1)).alias("negative_count"))
    return direction.crossJoin(listed).withColumn(
        "direction_stable", ~((F.col("grid_positive") > 0) & (F.col("grid_negative") > 0))
    )
