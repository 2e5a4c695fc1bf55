"""Diagnostics over the customer-month fact (G22-G26), per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.functions.months import month_norm
from beforeafter.operators.quantiles import exact_quantiles
from beforeafter.operators.ranking import bounded
from beforeafter.operators.rfm import MAX_MONTHS
from beforeafter.session import materialize


def _monthly(fact: DataFrame, month_col: str = "month_id") -> DataFrame:
    return fact.withColumn("month_id_norm", month_norm(F.col(month_col)))


def _stored(df: DataFrame, *cols: str) -> DataFrame:
    """The columns as a stored table: what they come from is computed once."""
    return materialize(df.select(*cols), "diagnostics")


def coverage(fact: DataFrame, month_col: str = "month_id") -> DataFrame:
    """Rows, distinct customers, zero-PRE and zero-POST rows and the
    median incremental revenue per month (exact median, see ``quantiles``).  The
    columns are stored once and read from there."""
    m = _stored(
        _monthly(fact, month_col), "month_id_norm", "customer_id", "pre_revenue", "post_revenue", "incremental_revenue"
    )
    counts = m.groupBy("month_id_norm").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum(F.when(F.col("pre_revenue") == 0, 1).otherwise(0)).cast("long").alias("zero_pre"),
        F.sum(F.when(F.col("post_revenue") == 0, 1).otherwise(0)).cast("long").alias("zero_post"),
    )
    med = exact_quantiles(m, "incremental_revenue", {"median_inc_rev": 0.5}, ["month_id_norm"])
    return counts.join(med, "month_id_norm", "left")


def histogram(fact: DataFrame, bins: int = 60, col: str = "incremental_revenue", month_col: str = "month_id") -> DataFrame:
    """Equal-width bins between the month's min and max; the top edge
    falls in the last bin; a month with one distinct value has one bin."""
    m = _stored(_monthly(fact, month_col).withColumn("__x", F.col(col).cast("double")), "month_id_norm", "__x")
    rng = m.groupBy("month_id_norm").agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    # One row per month: broadcast, so a month that holds most rows is not
    # funnelled through one join task.
    j = m.join(bounded(rng, MAX_MONTHS, "months"), "month_id_norm")
    width = F.col("__hi") - F.col("__lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / width * bins) + 1, F.lit(bins))
    ).cast("int")
    h = j.withColumn("bin", b).groupBy("month_id_norm", "bin", "__lo", "__hi").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return h.select(
        "month_id_norm",
        "bin",
        (F.col("__lo") + (F.col("bin") - 1) * (F.col("__hi") - F.col("__lo")) / bins).alias("bin_start"),
        (F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins).alias("bin_end"),
        "row_count",
    )


def rate_unpivot(fact: DataFrame, month_col: str = "month_id") -> DataFrame:
    """PRE and POST revenue per day as (period, value) rows."""
    m = _monthly(fact, month_col).select("customer_id", "month_id_norm", "pre_rev_per_day", "post_rev_per_day")
    return m.unpivot(
        ["customer_id", "month_id_norm"], ["pre_rev_per_day", "post_rev_per_day"], "period", "rev_per_day"
    )


def rate_box(fact: DataFrame, month_col: str = "month_id") -> DataFrame:
    """Min, quartiles (linear interpolation) and max per month and period."""
    u = _stored(rate_unpivot(fact, month_col), "month_id_norm", "period", "rev_per_day")
    return exact_quantiles(
        u,
        "rev_per_day",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
        ["month_id_norm", "period"],
        extremes=("min", "max"),
    )


def outliers(fact: DataFrame, n: int = 20, top: bool = True, month_col: str = "month_id") -> DataFrame:
    """The ``n`` most positive (or most negative) rows per month, ties by
    customer.  ``row_number() <= n`` lets Spark keep only ``n`` rows per month
    and partition before the shuffle (window group limit)."""
    m = _monthly(fact, month_col).withColumn("month_label", F.col("month_id_norm"))
    r = F.col("incremental_revenue")
    w = Window.partitionBy("month_id_norm").orderBy(r.desc() if top else r.asc(), F.col("customer_id").asc())
    ranked = m.withColumn("outlier_rank", F.row_number().over(w)).where(F.col("outlier_rank") <= n)
    return ranked.select(
        "customer_id", "month_label", "incremental_revenue", "pre_revenue", "post_revenue", "outlier_rank"
    )


def stage_audit(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named stage."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
