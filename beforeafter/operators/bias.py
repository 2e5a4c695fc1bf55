"""Bias controls (K1-K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.functions.months import month_end, month_key
from beforeafter.functions.numeric import exact_sum, ravg, rsum
from beforeafter.operators.quantiles import exact_quantiles
from beforeafter.session import materialize
from beforeafter.operators.ranking import bounded
from beforeafter.operators.rfm import MAX_MONTHS
from beforeafter.operators.windows import bucket_join


def rolling(by_month: DataFrame, n: int = 3, exact: bool = False) -> DataFrame:
    """K1: rolling sums over the last ``n`` months (the summary is one row per
    month, so the window over it is small)."""
    w = Window.orderBy(F.col("month_id").asc_nulls_last()).rowsBetween(-(n - 1), 0)

    def rs(c: str) -> Column:
        return exact_sum(c).over(w).cast("double") if exact else F.sum(c).over(w)

    return by_month.select(
        "month_id",
        "incremental_revenue",
        rs("incremental_revenue").alias("rolling_revenue"),
        rs("incremental_transactions").alias("rolling_transactions"),
        (rs("avg_delta_aov") / F.count("avg_delta_aov").over(w)).alias("rolling_mean_delta_aov"),
        F.count(F.lit(1)).over(w).alias("months_in_window"),
    )


def heavy_periods(exposures: DataFrame, q: float = 0.9) -> DataFrame:
    """Heavy contact periods: calendar months whose contact count is at least
    the ``q`` quantile of monthly contact counts.  One row per month at most,
    so the result is bounded by the calendar.  The counts, a row per month, are
    stored: the quantile reads them several times."""
    monthly = exposures.where(F.col("exposure_date").isNotNull()).groupBy(
        F.trunc("exposure_date", "MM").alias("period_start")
    ).agg(F.count(F.lit(1)).alias("contacts"))
    monthly = materialize(monthly, "contacts-by-month")
    thr = exact_quantiles(monthly, "contacts", {"__thr": q})
    return (
        monthly.crossJoin(F.broadcast(thr))
        .where(F.col("contacts") >= F.col("__thr"))
        .select("period_start", F.last_day("period_start").alias("period_end"), "contacts")
    )


def disjoint(periods: DataFrame) -> DataFrame:
    """``period_start, period_end`` of the days that ``periods`` cover, merged: no two
    overlap or touch.  Periods without a start or an end, or that end before they
    start, cover nothing.  For at most ``MAX_MONTHS`` periods (the order is one task's)."""
    start, end = F.col("period_start"), F.col("period_end")
    sorted_ = Window.orderBy("period_start", "period_end")
    before = sorted_.rowsBetween(Window.unboundedPreceding, -1)
    marked = periods.where(start <= end).select(start, end, F.max("period_end").over(before).alias("__reach"))
    new = F.coalesce(start > F.date_add("__reach", 1), F.lit(True)).cast("int")
    numbered = marked.withColumn("__n", F.sum(new).over(sorted_.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy("__n").agg(F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end"))
    return merged.drop("__n")


#: Halvings that find a place among ``MAX_MONTHS`` periods.
_HALVINGS = MAX_MONTHS.bit_length()


def _touches(fact: DataFrame, periods: DataFrame, pre_days: int, post_days: int) -> DataFrame:
    """``fact`` with ``__touch``: whether the row's PRE or POST window touches a
    period.  The merged periods, at most ``MAX_MONTHS``, travel as one row with a
    sorted list; of those that start by the window's end only the last can reach
    into the window, and halving the list finds it."""
    listed = disjoint(bounded(periods, MAX_MONTHS, "periods")).agg(
        F.array_sort(F.collect_list(F.struct("period_start", "period_end"))).alias("__periods")
    )
    begin, end = F.date_sub("anchor_exposure_date", pre_days), F.date_add("anchor_exposure_date", post_days - 1)

    def halve(at: Column, _: Column) -> Column:
        # the first `low` periods start by the window's end, those from `high` on after it
        mid, unsure = F.shiftright(at["low"] + at["high"], 1), at["low"] < at["high"]
        starts = F.get("__periods", mid.cast("int"))["period_start"]
        return F.struct(
            F.when(unsure & (starts <= end), mid + 1).otherwise(at["low"]).alias("low"),
            F.when(unsure & (starts > end), mid).otherwise(at["high"]).alias("high"),
        )

    whole = F.struct(F.lit(0).cast("long").alias("low"), F.size("__periods").cast("long").alias("high"))
    place = F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), whole, halve, lambda at: at["low"])
    placed = fact.crossJoin(F.broadcast(listed)).withColumn("__place", place)
    last = F.get("__periods", (F.col("__place") - 1).cast("int"))["period_end"]
    return placed.withColumn("__touch", F.coalesce(last >= begin, F.lit(False))).drop("__periods", "__place")


def exclude_periods(fact: DataFrame, periods: DataFrame, pre_days: int = 28, post_days: int = 7) -> DataFrame:
    """K2: drop customer-months whose PRE or POST window touches a period."""
    return _touches(fact, periods, pre_days, post_days).where(~F.col("__touch")).drop("__touch")


def annotate_periods(fact: DataFrame, periods: DataFrame, pre_days: int = 28, post_days: int = 7) -> DataFrame:
    """K3: ``period_flag`` = promo when the window touches a period, else quiet."""
    flag = F.when(F.col("__touch"), "promo").otherwise("quiet")
    return _touches(fact, periods, pre_days, post_days).withColumn("period_flag", flag).drop("__touch")


def compare_periods(annotated: DataFrame, exact: bool = False) -> DataFrame:
    """K3: lift in promo periods against quiet periods."""
    return annotated.groupBy("period_flag").agg(
        F.count(F.lit(1)).alias("customer_months"),
        rsum("incremental_revenue", exact).alias("incremental_revenue"),
        rsum("incremental_transactions", exact).alias("incremental_transactions"),
        ravg("delta_aov", exact).alias("avg_delta_aov"),
    )


def decay(anchor_df: DataFrame, days: DataFrame, horizon: int = 28, exact: bool = False) -> DataFrame:
    """K4: purchases by day offset from the anchor (0 .. horizon-1): revenue,
    purchase rows and customer-months buying on that day.  Offsets without
    any purchase are listed with zeros."""
    j = bucket_join(anchor_df, days, 0, horizon - 1).where(
        F.col("day").isNotNull() & ~F.col("is_repeat")
    )
    per = j.groupBy(F.datediff("day", "__a").alias("day_offset")).agg(
        rsum("revenue", exact).alias("revenue"),
        F.sum("n_rows").alias("purchase_rows"),
        F.count(F.lit(1)).alias("buying_customer_months"),
    )
    spark = anchor_df.sparkSession
    offsets = spark.range(horizon).select(F.col("id").cast("int").alias("day_offset"))
    out = offsets.join(per, "day_offset", "left")
    return out.select(
        "day_offset",
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        F.coalesce("purchase_rows", F.lit(0)).cast("long").alias("purchase_rows"),
        F.coalesce("buying_customer_months", F.lit(0)).cast("long").alias("buying_customer_months"),
    )


def frozen_segments(fact: DataFrame, rfm: DataFrame) -> DataFrame:
    """K5: each customer-month gets the segment of the customer as of the end
    of the previous month, so the segment cannot see the month's own purchases.

    RFM rows are keyed by their month; with day keys (yyyyMMdd) only the row
    of the month's last day counts, so there is one segment per month.
    """
    end = month_end(F.col("month_id"))
    is_month_row = (F.col("month_id") == month_key(F.col("month_id"))) | (F.col("month_id") % 100 == F.dayofmonth(end))
    r = rfm.where(is_month_row & F.col("customer_id").isNotNull()).select(
        F.col("customer_id").alias("__rc"),
        F.date_format(F.date_add(end, 1), "yyyyMM").cast("int").alias("__next"),
        F.col("rfm_segment").alias("frozen_segment"),
    )
    return fact.join(
        r, (fact["customer_id"] == r["__rc"]) & (fact["month_key_yyyymm"] == r["__next"]), "left"
    ).drop("__rc", "__next")


def summary_frozen(fact: DataFrame, rfm: DataFrame, exact: bool = False) -> DataFrame:
    """K5: the segment summary with frozen (previous month) segments."""
    f = frozen_segments(fact, rfm)
    return f.groupBy(F.col("month_key_yyyymm").alias("month_id"), "frozen_segment").agg(
        F.countDistinct("customer_id").alias("customers"),
        rsum("incremental_revenue", exact).alias("incremental_revenue"),
        rsum("incremental_transactions", exact).alias("incremental_transactions"),
        ravg("delta_aov", exact).alias("avg_delta_aov"),
    )


def transitions(rfm: DataFrame) -> DataFrame:
    """K6: customers moving from one segment to another between consecutive
    months.  The window is per customer (at most one row per month)."""
    r = rfm.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        month_key(F.col("month_id")).alias("month_key"),
        "rfm_segment",
    ).where(F.col("month_key").isNotNull())
    w = Window.partitionBy("customer_id").orderBy("month_key")
    prev_key = F.lag("month_key").over(w)
    prev_seg = F.lag("rfm_segment").over(w)
    t = r.select("*", prev_key.alias("__pk"), prev_seg.alias("from_segment"))
    month_start = F.to_date(F.concat(F.col("month_key").cast("string"), F.lit("01")), "yyyyMMdd")
    expected_prev = F.date_format(F.add_months(month_start, -1), "yyyyMM").cast("int")
    t = t.where(F.col("__pk") == expected_prev)
    return t.groupBy("month_key", "from_segment", F.col("rfm_segment").alias("to_segment")).agg(
        F.count(F.lit(1)).alias("customers")
    )
