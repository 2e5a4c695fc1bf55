"""Anchors and PRE/POST windows.

The range join of the method ("purchases of the same customer between two
dates") is built in three steps that each scale:

1. ``purchase_days``: purchases are pre-aggregated to one row per customer and
   day.  A customer who holds a large share of all purchases collapses to at
   most one row per day before any join, and the aggregation combines
   map-side.  ``COUNT(DISTINCT transaction_id)`` stays exact: every
   (customer, id, day) occurrence knows the previous day the same id occurred;
   an occurrence is new for a window ``[lo, hi]`` when it has no previous day
   or the previous day is before ``lo``.  First occurrences are summed per day;
   the rare repeats travel as their own rows.
2. Anchors are exploded to the few fixed-width date buckets their window
   touches and joined on ``(customer_id, bucket)``; the range test is a
   residual.  The join never pairs an anchor with purchases outside a bucket
   next to its window, so long histories do not grow the join.
3. Every window (PRE, POST, or all nine of the sensitivity grid) is a
   conditional aggregate over that one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.config import DEFAULT, LiftConfig

ANCHOR_KEYS = ["customer_id", "month_id"]


def anchors(exposures: DataFrame) -> DataFrame:
    """First contact date per customer and stored ``month_id``."""
    return exposures.groupBy("customer_id", "month_id").agg(
        F.min("exposure_date").alias("anchor_exposure_date")
    )


def bounds(anchor_df: DataFrame, pre_days: int = DEFAULT.pre_days, post_days: int = DEFAULT.post_days) -> DataFrame:
    """PRE = [anchor - pre, anchor - 1], POST = [anchor, anchor + post - 1]."""
    a = F.col("anchor_exposure_date")
    return anchor_df.select(
        *anchor_df.columns,
        F.date_sub(a, pre_days).alias("pre_start"),
        F.date_sub(a, 1).alias("pre_end"),
        a.alias("post_start"),
        F.date_add(a, post_days - 1).alias("post_end"),
    )


def purchase_days(transactions: DataFrame) -> DataFrame:
    """Customer-day purchase stream.

    Columns: ``customer_id, day, is_repeat, prev_day, n_new, n_rows, revenue,
    n_occ``.  Day rows (``is_repeat = false``, one per customer and day) carry
    the number of transaction ids whose first occurrence for the customer is
    that day, the raw row count and the revenue sum.  Repeat rows carry, per
    (customer, day, previous day), how many ids that occurred on ``prev_day``
    occur again on ``day`` (none when ids sit on one day each).

    One pass: (customer, id, day) occurrences are combined map-side, the
    previous day of each occurrence comes from a window per (customer, id),
    and both row kinds come out of one aggregation.
    """
    occ = (
        transactions.select(
            "customer_id",
            "transaction_id",
            F.col("transaction_date").alias("day"),
            "revenue",
        )
        .where(F.col("day").isNotNull())
        .groupBy("customer_id", "transaction_id", "day")
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n_rows"))
    )
    w = Window.partitionBy("customer_id", "transaction_id").orderBy("day")
    prev = F.when(F.col("transaction_id").isNotNull(), F.lag("day").over(w))
    occ = occ.withColumn("prev_day", prev)
    is_new = (F.col("transaction_id").isNotNull() & F.col("prev_day").isNull()).cast("long")
    day_part = F.struct(
        F.lit(False).alias("is_repeat"),
        F.lit(None).cast("date").alias("prev_day"),
        is_new.alias("n_new"),
        F.col("n_rows").alias("n_rows"),
        F.col("revenue").alias("revenue"),
    )
    repeat_part = F.when(
        F.col("prev_day").isNotNull(),
        F.struct(
            F.lit(True).alias("is_repeat"),
            F.col("prev_day").alias("prev_day"),
            F.lit(0).cast("long").alias("n_new"),
            F.lit(0).cast("long").alias("n_rows"),
            F.lit(None).cast("double").alias("revenue"),
        ),
    )
    parts = F.filter(F.array(day_part, repeat_part), lambda x: x.isNotNull())
    rows = occ.select("customer_id", "day", F.explode(parts).alias("__p")).select("customer_id", "day", "__p.*")
    return rows.groupBy("customer_id", "day", "is_repeat", "prev_day").agg(
        F.sum("n_new").alias("n_new"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("n_occ"),
    )


def bucket_join(
    anchor_df: DataFrame,
    days: DataFrame,
    lo: int,
    hi: int,
    anchor_col: str = "anchor_exposure_date",
    keys: list[str] | None = None,
) -> DataFrame:
    """Left join of anchors to the customer-day stream on
    ``day BETWEEN anchor + lo AND anchor + hi``.

    Anchors are exploded to the fixed-width (``hi - lo + 1`` days) buckets
    their window touches (at most two) and joined on
    ``(customer_id, bucket)``; the date range is a residual.  Output columns:
    ``keys``, ``__a`` (anchor date), ``day, n_new, n_rows, revenue, prev_day,
    is_repeat, n_occ`` (NULL when nothing matched).
    """
    keys = keys or ANCHOR_KEYS
    width = hi - lo + 1
    a_day = F.unix_date(F.col(anchor_col))
    a = anchor_df.select(
        *keys,
        F.col(anchor_col).alias("__a"),
        F.explode_outer(
            F.sequence(
                F.floor((a_day + lo) / width).cast("long"),
                F.floor((a_day + hi) / width).cast("long"),
            )
        ).alias("__b"),
    )
    d = days.select(
        F.col("customer_id").alias("__c"),
        F.floor(F.unix_date("day") / width).cast("long").alias("__db"),
        "day",
        "n_new",
        "n_rows",
        "revenue",
        "prev_day",
        "is_repeat",
        "n_occ",
    )
    cond = (
        (a["customer_id"] == d["__c"])
        & (a["__b"] == d["__db"])
        & d["day"].between(F.date_add(a["__a"], lo), F.date_add(a["__a"], hi))
    )
    return a.join(d, cond, "left").drop("__c", "__db", "__b")


def window_aggregates(
    anchor_df: DataFrame,
    days: DataFrame,
    windows: dict[str, tuple[int, int]],
    anchor_col: str = "anchor_exposure_date",
    keys: list[str] | None = None,
) -> DataFrame:
    """For each anchor row and each named window ``(lo, hi)`` (day offsets from
    the anchor, inclusive) return ``{name}_txn_cnt`` (distinct transaction
    ids), ``{name}_revenue`` (sum, 0.0 when none) and ``{name}_active_days``
    (distinct purchase days).  One bucketed join serves all windows.
    """
    keys = keys or ANCHOR_KEYS
    lo_all = min(lo for lo, _ in windows.values())
    hi_all = max(hi for _, hi in windows.values())
    j = bucket_join(anchor_df, days, lo_all, hi_all, anchor_col, keys)
    aggs = []
    for name, (lo, hi) in windows.items():
        start = F.date_add(F.col("__a"), lo)
        in_w = F.col("day").between(start, F.date_add(F.col("__a"), hi))
        day_row = in_w & ~F.col("is_repeat")
        first_in_w = in_w & F.col("is_repeat") & (F.col("prev_day") < start)
        aggs += [
            (
                F.coalesce(F.sum(F.when(day_row, F.col("n_new"))), F.lit(0))
                + F.coalesce(F.sum(F.when(first_in_w, F.col("n_occ"))), F.lit(0))
            ).alias(f"{name}_txn_cnt"),
            F.coalesce(F.sum(F.when(day_row, F.col("revenue"))), F.lit(0.0)).alias(f"{name}_revenue"),
            F.count(F.when(day_row, F.lit(1))).alias(f"{name}_active_days"),
        ]
    return j.groupBy(*keys, "__a").agg(*aggs).withColumnRenamed("__a", anchor_col)


def side_agg(
    anchor_df: DataFrame,
    transactions: DataFrame,
    side: str,
    cfg: LiftConfig = DEFAULT,
    days: DataFrame | None = None,
) -> DataFrame:
    """One window (``"pre"`` or ``"post"``) per anchor."""
    days = days if days is not None else purchase_days(transactions)
    win = {"pre": (-cfg.pre_days, -1), "post": (0, cfg.post_days - 1)}[side]
    out = window_aggregates(anchor_df, days, {side: win})
    return out.select(*ANCHOR_KEYS, f"{side}_txn_cnt", f"{side}_revenue", f"{side}_active_days")


def pre_post(
    anchor_df: DataFrame,
    transactions: DataFrame,
    cfg: LiftConfig = DEFAULT,
    days: DataFrame | None = None,
) -> DataFrame:
    """Anchors with zero-filled PRE and POST aggregates from one join."""
    days = days if days is not None else purchase_days(transactions)
    agg = window_aggregates(
        anchor_df, days, {"pre": (-cfg.pre_days, -1), "post": (0, cfg.post_days - 1)}
    )
    out = bounds(agg, cfg.pre_days, cfg.post_days)
    return out.select(
        "customer_id",
        "month_id",
        "anchor_exposure_date",
        "pre_start",
        "pre_end",
        "post_start",
        "post_end",
        "pre_txn_cnt",
        "pre_revenue",
        "pre_active_days",
        "post_txn_cnt",
        "post_revenue",
        "post_active_days",
    )
