"""RFM segmentation per customer and month.

The trailing window is a pure range join (purchases within ``days`` before
each month end, no customer key).  Joined as written it becomes a nested-loop
join that broadcasts the purchases.  Here every customer-day row is expanded
to the (at most ``days / 28 + 2``) month ends whose window can contain it and
joined on the month end; the month-end table is a calendar (one row per
``month_id`` of the date dimension), so broadcasting it is bounded by the
calendar, not by the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.config import DEFAULT, LiftConfig
from beforeafter.functions.months import month_end as month_end_expr
from beforeafter.operators.ranking import bounded, ntiles
from beforeafter.session import materialize


#: Months (rows of the calendar) that may be sent to every task.
MAX_MONTHS = 50_000


def month_ends(dates: DataFrame) -> DataFrame:
    """Distinct ``month_id`` of the date dimension with its month end."""
    return dates.select("month_id").distinct().select("month_id", month_end_expr(F.col("month_id")).alias("month_end"))


def trailing(
    transactions: DataFrame,
    ends: DataFrame,
    days: int = DEFAULT.rfm_days,
    stream: DataFrame | None = None,
) -> DataFrame:
    """Per customer and month: last purchase day, purchase rows and revenue
    in ``[month_end - days + 1, month_end]``.

    A month with no purchase in its window (or whose key does not parse)
    yields one row with a NULL customer and a row count of 1, as the left
    join of the method does.  Which months have one is told by the purchase days
    alone, so the aggregate behind its exchange serves every use of the result.
    """
    if stream is None:  # rows and revenue need no look at repeated ids
        bought = transactions.select("customer_id", F.col("transaction_date").alias("day"), "revenue").where(F.col("day").isNotNull())
        d = bought.groupBy("customer_id", "day").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("revenue").alias("revenue"))
    else:
        bought = stream.where(~F.col("is_repeat"))
        d = bought.select("customer_id", "day", "n_rows", "revenue")
    e = bounded(ends.where(F.col("month_end").isNotNull()), MAX_MONTHS, "months")
    j = _reach(d, days).join(e, F.col("__me") == e["month_end"], "inner")
    agg = j.groupBy("customer_id", "month_id", "month_end").agg(
        F.max("day").alias("last_purchase_date"),
        F.sum("n_rows").alias("txns_90d"),
        F.sum("revenue").alias("rev_90d"),
    )
    reached = _reach(bought.select("day").distinct(), days).select(F.col("__me").alias("__pe")).distinct()
    present = bounded(reached, MAX_MONTHS, "months")  # at most one row per month of the calendar
    empty = ends.join(present, ends["month_end"] == present["__pe"], "left_anti").select(
        F.lit(None).cast("long").alias("customer_id"),
        "month_id",
        "month_end",
        F.lit(None).cast("date").alias("last_purchase_date"),
        F.lit(1).cast("long").alias("txns_90d"),
        F.lit(None).cast("double").alias("rev_90d"),
    )
    return agg.unionByName(empty)


def _reach(df: DataFrame, days: int) -> DataFrame:
    """Each row once per month end whose ``days``-day window contains ``day``."""
    out = df.select(
        "*",
        F.explode(
            F.sequence(
                F.trunc("day", "MM"),
                F.trunc(F.date_add("day", days - 1), "MM"),
                F.expr("INTERVAL 1 MONTH"),
            )
        ).alias("__m"),
    ).withColumn("__me", F.last_day("__m"))
    return out.where(F.col("__me") <= F.date_add("day", days - 1)).drop("__m")


def rfm_values(windowed: DataFrame) -> DataFrame:
    """Recency in days (999 without purchase), frequency, monetary."""
    return windowed.select(
        "customer_id",
        "month_id",
        F.when(
            F.col("last_purchase_date").isNull() | F.col("month_end").isNull(), F.lit(999)
        )
        .otherwise(F.datediff("month_end", "last_purchase_date"))
        .cast("int")
        .alias("recency_days"),
        F.coalesce("txns_90d", F.lit(0)).cast("long").alias("frequency_90d"),
        F.coalesce("rev_90d", F.lit(0.0)).alias("monetary_90d"),
    )


def score_keys(recency_best_high: bool = False) -> dict[str, Column]:
    """What each score orders by, as whole numbers: days, purchases, cents.  Ties
    are broken by ``customer_id``, so scores are deterministic."""
    days = F.col("recency_days").cast("long")
    return {
        "r_score": -days if recency_best_high else days,
        "f_score": F.col("frequency_90d").cast("long"),
        "m_score": F.round(F.round("monetary_90d", 2) * 100).cast("long"),
    }


def scores(values: DataFrame, cfg: LiftConfig = DEFAULT) -> DataFrame:
    """Quintile scores within each month, without sorting a month
    (see :func:`ntiles`).

    ``recency_best_high=False`` (default) keeps the documented behaviour in
    which the most recent buyers get ``r_score = 1``.  The values are stored first:
    the ranking reads them five times.
    """
    values = materialize(values, "rfm-values")
    return ntiles(values, "month_id", score_keys(cfg.recency_best_high), F.col("customer_id"), cfg.buckets)


def code() -> Column:
    """E5: ``R#F#M#``."""
    return F.concat(
        F.lit("R"), F.col("r_score").cast("string"), F.lit("F"), F.col("f_score").cast("string"),
        F.lit("M"), F.col("m_score").cast("string"),
    )


def segment() -> Column:
    """Six named segments; the order of the tests matters."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 4) & (f >= 3), "Loyal")
        .when((r >= 3) & (f >= 3), "Potential Loyalists")
        .when((r <= 2) & (f <= 2), "At Risk")
        .when(r == 1, "Lost")
        .otherwise("Others")
    )


def segments(
    transactions: DataFrame,
    dates: DataFrame,
    cfg: LiftConfig = DEFAULT,
    stream: DataFrame | None = None,
) -> DataFrame:
    """The customer-month RFM dimension: scores, code and segment."""
    v = rfm_values(trailing(transactions, month_ends(dates), cfg.rfm_days, stream))
    return scores(v, cfg).select(
        "customer_id", "month_id", "r_score", "f_score", "m_score",
        code().alias("rfm_code"), segment().alias("rfm_segment"),
    )
