"""Queries for RFM (E1-E8) and the segment summary (F2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.config import LiftConfig
from beforeafter.operators import lift, rfm, summary, windows
from beforeafter.plans import sql as S
from beforeafter.plans.present import round_cols
from beforeafter.plans.registry import register
from beforeafter.session import materialize
from beforeafter.sources.bindings import binding_a

RFM_CHAIN = S.BINDING_A + S.DATES + S.rfm_sql()


def _rfm_parts(spark: SparkSession, sf_dir: str):
    b = binding_a(spark, sf_dir)
    return b, rfm.month_ends(b.dates)


@register("month_ends", S.with_(RFM_CHAIN) + "SELECT month_id, month_end FROM month_ends")
def q_month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.month_ends(binding_a(spark, sf_dir).dates)


@register(
    "rfm_trailing",
    S.with_(RFM_CHAIN)
    + "SELECT customer_id, month_id, month_end, last_purchase_date, txns_90d, ROUND(rev_90d, 4) AS rev_90d FROM trail",
)
def q_rfm_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, ends = _rfm_parts(spark, sf_dir)
    return round_cols(rfm.trailing(b.transactions, ends), {"rev_90d": 4})


@register(
    "rfm_values",
    S.with_(RFM_CHAIN)
    + "SELECT customer_id, month_id, recency_days, frequency_90d, ROUND(monetary_90d, 4) AS monetary_90d FROM rfm_values",
)
def q_rfm_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, ends = _rfm_parts(spark, sf_dir)
    return round_cols(rfm.rfm_values(rfm.trailing(b.transactions, ends)), {"monetary_90d": 4})


def _scores(spark: SparkSession, sf_dir: str, cfg: LiftConfig = LiftConfig()) -> DataFrame:
    b, ends = _rfm_parts(spark, sf_dir)
    v = rfm.rfm_values(rfm.trailing(b.transactions, ends))
    return rfm.scores(v, cfg).select("customer_id", "month_id", "r_score", "f_score", "m_score")


SCORES_SQL = S.with_(RFM_CHAIN) + "SELECT customer_id, month_id, r_score, f_score, m_score FROM rfm_scores"


@register("rfm_scores", SCORES_SQL)
def q_rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)


@register(
    "rfm_scores_scalable",
    S.with_(S.BINDING_A, S.DATES, S.rfm_sql(days=30)) + "SELECT customer_id, month_id, r_score, f_score, m_score FROM rfm_scores",
)
def q_rfm_scores_scalable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores over a 30-day window, in which most values are tied, so that the
    ends of the fifths lie inside ties and are found by customer."""
    b, ends = _rfm_parts(spark, sf_dir)
    v = rfm.rfm_values(rfm.trailing(b.transactions, ends, 30))
    return rfm.scores(v).select("customer_id", "month_id", "r_score", "f_score", "m_score")


@register(
    "rfm_code_counts",
    S.with_(RFM_CHAIN) + "SELECT month_id, rfm_code, COUNT(*) AS customers FROM rfm GROUP BY month_id, rfm_code",
)
def q_rfm_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = binding_a(spark, sf_dir)
    seg = rfm.segments(b.transactions, b.dates)
    return seg.groupBy("month_id", "rfm_code").agg(F.count(F.lit(1)).alias("customers"))


@register("rfm_segments", S.with_(RFM_CHAIN) + "SELECT * FROM rfm")
def q_rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = binding_a(spark, sf_dir)
    return rfm.segments(b.transactions, b.dates)


@register(
    "rfm_segments_recency_high",
    S.with_(S.BINDING_A, S.DATES, S.rfm_sql(recency_desc=True)) + "SELECT * FROM rfm",
)
def q_rfm_segments_recency_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recency sorted descending, so recent buyers score high."""
    b = binding_a(spark, sf_dir)
    return rfm.segments(b.transactions, b.dates, LiftConfig(recency_best_high=True))


@register("summary_rfm", S.with_(S.gold_a()) + "SELECT * FROM agg_rfm")
def q_summary_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact and RFM dimension share one stored purchase stream."""
    b = binding_a(spark, sf_dir)
    days = materialize(windows.purchase_days(b.transactions), "purchase-days")
    fact = lift.fact(windows.pre_post(windows.anchors(b.exposures), b.transactions, days=days), b.unflagged)
    return summary.by_rfm(fact, rfm.segments(b.transactions, b.dates, stream=days), exact=True)
