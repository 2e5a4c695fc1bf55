"""Analytical views over the gold tables.

Each view is one lazy Spark plan over the gold summaries (or the fact) and
returns every month unless ``month`` is given; picking "the latest month" is
a join to :func:`latest_month`, never a collect.  Means of monthly means are
kept apart from row-weighted means (the pages average averages).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.functions.months import month_norm, month_sort_key
from beforeafter.functions.numeric import ravg, rsum, to_number

UNKNOWN = "Unknown"
# Group labels of the flag dimensions.
VALUE_LABELS = {0: "Low Value", 1: "High Value"}
ACTIVE_LABELS = {0: "Non-Active", 1: "Active"}


def _label(col: str, labels: dict[int, str]) -> Column:
    c = F.col(col).cast("int")
    out = None
    for k, v in labels.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def month_fields(df: DataFrame, col: str = "month_id") -> DataFrame:
    """G1: ``month_id_norm`` (text key, "Unknown" when missing) and ``month_label``."""
    norm = month_norm(F.col(col)) if col in df.columns else F.lit(UNKNOWN)
    out = df.withColumn("month_id_norm", norm)
    if "month_label" in df.columns:
        return out.withColumn("month_label", F.coalesce(F.col("month_label").cast("string"), F.col("month_id_norm")))
    return out.withColumn("month_label", F.col("month_id_norm"))


def with_sort_key(df: DataFrame) -> DataFrame:
    """Sortable month key next to ``month_id_norm``."""
    return df.withColumn("month_sort_key", month_sort_key(F.col("month_id_norm")))


def latest_month(df: DataFrame) -> DataFrame:
    """One row: number of known months and the latest one (text order)."""
    known = df.where(F.col("month_id_norm") != UNKNOWN)
    return known.agg(
        F.countDistinct("month_id_norm").alias("months"), F.max("month_id_norm").alias("latest_month")
    )


def for_month(df: DataFrame, month: str | None = None) -> DataFrame:
    """Rows of one month; by default the latest (semi join, one-row side)."""
    if month is not None:
        return df.where(F.col("month_id_norm") == month)
    latest = latest_month(df).select(F.col("latest_month").alias("__lm"))
    return df.join(F.broadcast(latest), F.col("month_id_norm") == F.col("__lm"), "left_semi")


def headline(by_month: DataFrame, exact: bool = False) -> DataFrame:
    """Total incremental revenue and transactions, mean of monthly mean delta AOV."""
    return by_month.agg(
        rsum("incremental_revenue", exact).alias("total_inc_rev"),
        rsum("incremental_transactions", exact).alias("total_inc_txn"),
        ravg("avg_delta_aov", exact).alias("mean_of_means_delta_aov"),
    )


def month_trend(by_month: DataFrame) -> DataFrame:
    """Revenue by month with its label and sort key."""
    m = with_sort_key(month_fields(by_month))
    return m.select("month_id_norm", "month_label", "month_sort_key", "incremental_revenue")


def segment_month(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """One row per month and segment (NULL segment reads "Unknown")."""
    m = month_fields(by_rfm).withColumn("rfm_segment", F.coalesce("rfm_segment", F.lit(UNKNOWN)))
    for c in ("incremental_revenue", "customers", "incremental_transactions", "avg_delta_aov"):
        m = m.withColumn(c, to_number(F.col(c)))
    return m.groupBy("month_id_norm", "month_label", "rfm_segment").agg(
        rsum("incremental_revenue", exact).alias("incremental_revenue"),
        rsum("customers", exact).alias("customers"),
        rsum("incremental_transactions", exact).alias("incremental_transactions"),
        ravg("avg_delta_aov", exact).alias("avg_delta_aov"),
    )


def segment_ranking(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """Segments ranked by revenue within each month (ties by name)."""
    s = segment_month(by_rfm, exact)
    w = Window.partitionBy("month_id_norm").orderBy(F.desc("incremental_revenue"), F.asc("rfm_segment"))
    return s.select(
        "month_id_norm", "rfm_segment", "incremental_revenue", F.row_number().over(w).alias("segment_rank")
    ).withColumn("is_top", F.col("segment_rank") == 1)


def value_split(by_flags: DataFrame, exact: bool = False) -> DataFrame:
    """All, high-value and low-value incremental revenue per month."""
    m = month_fields(by_flags)
    hv = F.col("is_high_value").cast("int")
    return m.groupBy("month_id_norm").agg(
        rsum("incremental_revenue", exact).alias("inc_all"),
        rsum(F.when(hv == 1, F.col("incremental_revenue")).otherwise(0.0), exact).alias("inc_high_value"),
        rsum(F.when(hv == 0, F.col("incremental_revenue")).otherwise(0.0), exact).alias("inc_low_value"),
    )


def by_value_group(by_flags: DataFrame, exact: bool = False) -> DataFrame:
    """Revenue per month and value group (unmapped flags left out)."""
    m = month_fields(by_flags).withColumn("value_group", _label("is_high_value", VALUE_LABELS))
    return (
        m.where(F.col("value_group").isNotNull())
        .groupBy("month_id_norm", "value_group")
        .agg(rsum("incremental_revenue", exact).alias("incremental_revenue"))
    )


def active_by_value(by_flags: DataFrame, exact: bool = False) -> DataFrame:
    """Month x active group x value group table (mean of means for AOV)."""
    m = (
        month_fields(by_flags)
        .withColumn("value_group", _label("is_high_value", VALUE_LABELS))
        .withColumn("active_group", _label("is_active", ACTIVE_LABELS))
    )
    return (
        m.where(F.col("value_group").isNotNull() & F.col("active_group").isNotNull())
        .groupBy("month_id_norm", "active_group", "value_group")
        .agg(
            rsum("incremental_revenue", exact).alias("incremental_revenue"),
            rsum("incremental_transactions", exact).alias("incremental_transactions"),
            ravg("avg_delta_aov", exact).alias("avg_delta_aov"),
            F.sum("customers").alias("customers"),
        )
    )


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Named columns to double; text that does not parse becomes 0.0."""
    out = df
    for c in cols:
        out = out.withColumn(c, to_number(F.col(c)))
    return out


def active_trend(by_flags: DataFrame, exact: bool = False) -> DataFrame:
    """Month x active roll-up (both trend lines)."""
    cols = ["incremental_revenue", "incremental_transactions", "avg_delta_aov", "customers", "is_active"]
    m = month_fields(coerce_numeric(by_flags, cols)).withColumn("is_active", F.col("is_active").cast("int"))
    return (
        m.groupBy("month_id_norm", "month_label", "is_active")
        .agg(
            rsum("customers", exact).alias("customers"),
            rsum("incremental_revenue", exact).alias("incremental_revenue"),
            rsum("incremental_transactions", exact).alias("incremental_transactions"),
            ravg("avg_delta_aov", exact).alias("avg_delta_aov"),
        )
        .withColumn("active_group", _label("is_active", ACTIVE_LABELS))
    )


def active_split(by_flags: DataFrame, exact: bool = False) -> DataFrame:
    """Active and non-active revenue and transactions per month."""
    t = active_trend(by_flags, exact)

    def pick(flag: int, c: str) -> Column:
        return rsum(F.when(F.col("is_active") == flag, F.col(c)).otherwise(0.0), exact)

    return t.groupBy("month_id_norm").agg(
        pick(1, "incremental_revenue").alias("active_rev"),
        pick(0, "incremental_revenue").alias("nonactive_rev"),
        pick(1, "incremental_transactions").alias("active_txn"),
        pick(0, "incremental_transactions").alias("nonactive_txn"),
    )


def contribution(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """Net, positive and negative segment contributions per month."""
    s = segment_month(by_rfm, exact)
    r = F.col("incremental_revenue")
    return s.groupBy("month_id_norm").agg(
        rsum(r, exact).alias("total_rev_net"),
        rsum(F.when(r > 0, r).otherwise(0.0), exact).alias("total_rev_pos"),
        rsum(F.when(r < 0, r).otherwise(0.0), exact).alias("total_rev_neg"),
    )


def top_bottom(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """Top and bottom segment per month (ties by segment name)."""
    s = segment_month(by_rfm, exact)
    top = Window.partitionBy("month_id_norm").orderBy(F.desc("incremental_revenue"), F.asc("rfm_segment"))
    bot = Window.partitionBy("month_id_norm").orderBy(F.asc("incremental_revenue"), F.desc("rfm_segment"))
    s = s.withColumn("__t", F.row_number().over(top)).withColumn("__b", F.row_number().over(bot))
    return s.groupBy("month_id_norm").agg(
        F.max(F.when(F.col("__t") == 1, F.col("rfm_segment"))).alias("top_segment"),
        F.max(F.when(F.col("__t") == 1, F.col("incremental_revenue"))).alias("top_rev"),
        F.max(F.when(F.col("__b") == 1, F.col("rfm_segment"))).alias("bottom_segment"),
        F.max(F.when(F.col("__b") == 1, F.col("incremental_revenue"))).alias("bottom_rev"),
    )


def shares(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """Top segment's share of net and of positive contributions,
    and the flag for "top exceeds net" (other segments offset it)."""
    tb = top_bottom(by_rfm, exact).join(contribution(by_rfm, exact), "month_id_norm")
    of_net = F.when(F.col("total_rev_net") != 0, F.col("top_rev") / F.col("total_rev_net"))
    of_pos = F.when(F.col("total_rev_pos") > 0, F.col("top_rev") / F.col("total_rev_pos"))
    return tb.select(
        "month_id_norm",
        "top_segment",
        "top_rev",
        "total_rev_net",
        "total_rev_pos",
        of_net.alias("share_of_net"),
        of_pos.alias("share_of_positive"),
        F.coalesce(of_net > 1.0, F.lit(False)).alias("top_exceeds_net"),
        F.coalesce(of_net < 0.0, F.lit(False)).alias("net_negative_share"),
    )


def contribution_sign(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """Each month's segments labelled Positive, Negative or Zero."""
    s = segment_month(by_rfm, exact)
    r = F.col("incremental_revenue")
    return s.select(
        "month_id_norm",
        "rfm_segment",
        F.when(r > 0, "Positive").when(r < 0, "Negative").otherwise("Zero").alias("contribution_sign"),
        "incremental_revenue",
        "customers",
        "incremental_transactions",
        "avg_delta_aov",
    )


def segment_matrix(by_rfm: DataFrame, exact: bool = False) -> DataFrame:
    """Revenue of every segment in every month, one row each, 0 where a
    segment has none.  Segments and months come from the summary itself: the months
    are gathered per segment (a calendar's worth) and exploded."""
    m = month_fields(by_rfm).withColumn("rfm_segment", F.coalesce("rfm_segment", F.lit(UNKNOWN)))
    m = m.withColumn("incremental_revenue", to_number(F.col("incremental_revenue")))
    cells = m.groupBy("rfm_segment", "month_label").agg(rsum("incremental_revenue", exact).alias("__v"))
    months = cells.agg(F.collect_set("month_label").alias("__months"))  # one row
    grid = cells.select(F.col("rfm_segment").alias("__s")).distinct().crossJoin(F.broadcast(months))
    grid = grid.select("__s", F.explode("__months").alias("__m"))
    out = grid.join(cells, (grid["__s"] == cells["rfm_segment"]) & (grid["__m"] == cells["month_label"]), "left")
    return out.select(
        F.col("__s").alias("rfm_segment"),
        F.col("__m").alias("month_label"),
        F.coalesce("__v", F.lit(0.0)).alias("incremental_revenue"),
    )


def segment_matrix_wide(matrix: DataFrame, months: list[str]) -> DataFrame:
    """G20 as a table: one row per segment and a column for each of ``months``."""
    wide = [
        F.coalesce(F.max(F.when(F.col("month_label") == m, F.col("incremental_revenue"))), F.lit(0.0)).alias(m)
        for m in months
    ]
    return matrix.groupBy("rfm_segment").agg(*wide)


def top_n_trend(by_rfm: DataFrame, n: int = 5, exact: bool = False) -> DataFrame:
    """Revenue by month for the overall top ``n`` segments."""
    m = month_fields(by_rfm).withColumn("rfm_segment", F.coalesce("rfm_segment", F.lit(UNKNOWN)))
    m = m.withColumn("incremental_revenue", to_number(F.col("incremental_revenue")))
    overall = m.groupBy("rfm_segment").agg(rsum("incremental_revenue", exact).alias("__tot"))
    top = overall.orderBy(F.desc("__tot"), F.asc("rfm_segment")).limit(n).select(
        F.col("rfm_segment").alias("__s")
    )
    per = m.groupBy("rfm_segment", "month_label").agg(
        rsum("incremental_revenue", exact).alias("incremental_revenue")
    )
    # ``top`` has at most n rows.
    return per.join(F.broadcast(top), per.rfm_segment == top.__s, "left_semi")
