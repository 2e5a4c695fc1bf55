"""Queries for the core chain: anchors, windows, lift fact and gold summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.config import DEFAULT, LiftConfig
from beforeafter.functions.months import month_key
from beforeafter.operators import lift, summary, windows
from beforeafter.plans import sql as S
from beforeafter.plans.present import FACT_DOUBLES, round_cols, six, sql_round
from beforeafter.plans.registry import register
from beforeafter.sources.bindings import Binding, binding_a, binding_b

EVENTS_CFG = LiftConfig(pre_days=14, post_days=7)
EVENTS_SHORT_CFG = LiftConfig(pre_days=7, post_days=3)


@dataclass
class Chain:
    binding: Binding
    days: DataFrame
    anchors: DataFrame
    pre_post: DataFrame
    fact: DataFrame


def chain(spark: SparkSession, sf_dir: str, cfg: LiftConfig = DEFAULT, which: str = "a", flags: bool = True) -> Chain:
    """Binding, purchase stream, anchors, windows and fact, as lazy plans; the
    fact's customer flags are null unless ``flags``."""

    b = binding_a(spark, sf_dir) if which == "a" else binding_b(spark, sf_dir)
    days = windows.purchase_days(b.transactions)
    anc = windows.anchors(b.exposures)
    pp = windows.pre_post(anc, b.transactions, cfg, days=days)
    return Chain(b, days, anc, pp, lift.fact(pp, b.customers if flags else b.unflagged, cfg))


# ---------------------------------------------------------------- anchors (C)


@register("anchors", S.with_(S.BINDING_A, S.anchors_sql()) + "SELECT * FROM anchors")
def q_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.anchors(binding_a(spark, sf_dir).exposures)


@register(
    "window_bounds",
    S.with_(S.BINDING_A, S.anchors_sql(), S.pre_post_sql())
    + "SELECT customer_id, month_id, anchor_exposure_date, pre_start, pre_end, post_start, post_end FROM pre_post",
)
def q_window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.bounds(windows.anchors(binding_a(spark, sf_dir).exposures))


def _side_sql(side: str) -> str:
    return (
        S.with_(S.BINDING_A, S.anchors_sql(), S.pre_post_sql())
        + f"SELECT customer_id, month_id, {side}_txn_cnt, ROUND({side}_revenue, 4) AS {side}_revenue, "
        f"{side}_active_days FROM pre_post"
    )


def _side(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    b = binding_a(spark, sf_dir)
    out = windows.side_agg(windows.anchors(b.exposures), b.transactions, side)
    return round_cols(out, {f"{side}_revenue": 4})


@register("pre_agg", _side_sql("pre"))
def q_pre_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _side(spark, sf_dir, "pre")


@register("post_agg", _side_sql("post"))
def q_post_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _side(spark, sf_dir, "post")


PP_DIGITS = {"pre_revenue": 4, "post_revenue": 4}


@register(
    "pre_post",
    sql_round(S.with_(S.chain_a()) + "SELECT * FROM pre_post", PP_DIGITS),
)
def q_pre_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(chain(spark, sf_dir).pre_post, PP_DIGITS)


@register(
    "pre_post_events",
    sql_round(S.with_(S.chain_b(14, 7)) + "SELECT * FROM pre_post", PP_DIGITS),
)
def q_pre_post_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(chain(spark, sf_dir, EVENTS_CFG, "b").pre_post, PP_DIGITS)


# ---------------------------------------------------------------- lift (D)

BASE_COLS = (
    "customer_id, month_id, anchor_exposure_date, is_active, is_high_value, pre_txn_cnt, "
    "ROUND(pre_revenue, 4) AS pre_revenue, pre_active_days, post_txn_cnt, ROUND(post_revenue, 4) AS post_revenue, "
    "post_active_days, pre_days, post_days"
)


@register("lift_base", S.with_(S.chain_a()) + f"SELECT {BASE_COLS} FROM lift_rows")
def q_lift_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chain(spark, sf_dir)
    return round_cols(lift.base(c.pre_post, c.binding.customers), PP_DIGITS)


@register(
    "month_key",
    S.with_(S.BINDING_A, S.DATES)
    + f"SELECT month_id, date_id, {S.month_key('month_id')} AS key_from_month, {S.month_key('date_id')} AS key_from_day FROM dim_date",
)
def q_month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 over both key formats of the calendar (yyyyMM and yyyyMMdd)."""
    d = binding_a(spark, sf_dir).dates
    return d.select(
        "month_id",
        "date_id",
        month_key(F.col("month_id")).alias("key_from_month"),
        month_key(F.col("date_id")).alias("key_from_day"),
    )


RATE_COLS = [
    "pre_rev_per_day",
    "post_rev_per_day",
    "pre_txn_per_day",
    "post_txn_per_day",
    "pre_freq",
    "post_freq",
    "pre_aov",
    "post_aov",
]
DELTA_COLS = ["incremental_revenue", "incremental_transactions", "incremental_freq_points", "delta_aov"]


@register(
    "lift_rates",
    sql_round(
        S.with_(S.chain_a()) + "SELECT customer_id, month_id, " + ", ".join(RATE_COLS) + " FROM rated",
        six(RATE_COLS),
    ),
)
def q_lift_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chain(spark, sf_dir)
    r = lift.rates(lift.base(c.pre_post, c.binding.unflagged))
    return round_cols(r.select("customer_id", "month_id", *RATE_COLS), six(RATE_COLS))


@register(
    "lift_deltas",
    sql_round(
        S.with_(S.chain_a()) + "SELECT customer_id, month_id, " + ", ".join(DELTA_COLS) + " FROM fact",
        six(DELTA_COLS),
    ),
)
def q_lift_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chain(spark, sf_dir)
    d = lift.deltas(lift.rates(lift.base(c.pre_post, c.binding.unflagged)))
    return round_cols(d.select("customer_id", "month_id", *DELTA_COLS), six(DELTA_COLS))


@register("lift_fact", sql_round(S.with_(S.chain_a()) + "SELECT * FROM fact", six(FACT_DOUBLES)))
def q_lift_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(chain(spark, sf_dir).fact, six(FACT_DOUBLES))


@register(
    "lift_fact_events",
    sql_round(S.with_(S.chain_b(14, 7)) + "SELECT * FROM fact", six(FACT_DOUBLES)),
)
def q_lift_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(chain(spark, sf_dir, EVENTS_CFG, "b").fact, six(FACT_DOUBLES))


@register(
    "lift_fact_events_short",
    sql_round(S.with_(S.chain_b(7, 3)) + "SELECT * FROM fact", six(FACT_DOUBLES)),
)
def q_lift_fact_events_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(chain(spark, sf_dir, EVENTS_SHORT_CFG, "b").fact, six(FACT_DOUBLES))


# ---------------------------------------------------------------- summaries (F)

SUMMARY_MONTH_SQL = f"""SELECT month_key_yyyymm AS month_id, COUNT(DISTINCT customer_id) AS exposed_customer_months,
  {S.xsum('incremental_revenue')} AS incremental_revenue, {S.xsum('incremental_transactions')} AS incremental_transactions,
  {S.xavg('delta_aov')} AS avg_delta_aov
FROM fact GROUP BY month_key_yyyymm"""


@register("summary_month", S.with_(S.chain_a()) + SUMMARY_MONTH_SQL)
def q_summary_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.by_month(chain(spark, sf_dir, flags=False).fact, exact=True)


@register(
    "summary_flags",
    S.with_(S.chain_a())
    + """SELECT month_key_yyyymm AS month_id, is_active, is_high_value, COUNT(DISTINCT customer_id) AS customers,
  CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_revenue,
  CAST(SUM(CAST(incremental_transactions AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_transactions,
  CAST(SUM(CAST(delta_aov AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(delta_aov) AS avg_delta_aov
FROM fact GROUP BY month_key_yyyymm, is_active, is_high_value""",
)
def q_summary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.by_flags(chain(spark, sf_dir).fact, exact=True)
