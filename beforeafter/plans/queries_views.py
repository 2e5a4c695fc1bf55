"""Queries for the analytical views (G1-G21) and diagnostics."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from beforeafter.functions.months import month_sort_key
from beforeafter.operators import diagnostics, grains, lift, rfm, summary, windows
from beforeafter.plans import sql as S
from beforeafter.plans import views as V
from beforeafter.plans.present import round_cols
from beforeafter.plans.queries_core import chain
from beforeafter.plans.registry import register
from beforeafter.session import materialize
from beforeafter.sources.bindings import binding_a



class Gold:
    """Gold tables of binding A, written on first use and read from there: the
    purchase stream, the anchors and the fact once, the RFM dimension once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.binding = binding_a(spark, sf_dir)

    @cached_property
    def days(self):
        return materialize(windows.purchase_days(self.binding.transactions), "purchase-days")

    @cached_property
    def anchors(self):
        return materialize(windows.anchors(self.binding.exposures), "anchors")

    @cached_property
    def fact(self):
        pp = windows.pre_post(self.anchors, self.binding.transactions, days=self.days)
        return materialize(lift.fact(pp, self.binding.customers), "fact")

    @cached_property
    def lifts(self):
        """The fact without flags."""
        pp = windows.pre_post(self.anchors, self.binding.transactions, days=self.days)
        return materialize(lift.fact(pp, self.binding.unflagged), "lifts")

    @cached_property
    def rfm(self):
        return materialize(rfm.segments(self.binding.transactions, self.binding.dates, stream=self.days), "rfm")

    @cached_property
    def rolled(self):
        """Every grain of the fact, from one pass over fact and RFM dimension."""
        return materialize(grains.rollup(self.fact, self.rfm, exact=True), "rollup")

    @property
    def by_month(self):
        return summary.by_month(self.fact, exact=True)

    @property
    def by_flags(self):
        return summary.by_flags(self.fact, exact=True)

    @property
    def by_rfm(self):
        return summary.by_rfm(self.fact, self.rfm, exact=True)


def _sort_key_sql(x: str) -> str:
    return f"CASE WHEN length({x}) = 7 AND substr({x}, 5, 1) = '-' THEN replace({x}, '-', '') ELSE {x} END"


def _num(x: str) -> str:
    return f"COALESCE(TRY_CAST({x} AS DOUBLE), 0.0)"


VIEW_CTES = f"""
v_month AS (SELECT *, COALESCE(CAST(month_id AS VARCHAR), 'Unknown') AS month_id_norm FROM agg_month),
v_rfm AS (SELECT *, COALESCE(CAST(month_id AS VARCHAR), 'Unknown') AS month_id_norm FROM agg_rfm),
v_flags AS (SELECT *, COALESCE(CAST(month_id AS VARCHAR), 'Unknown') AS month_id_norm FROM agg_flags),
seg_month AS (
  SELECT month_id_norm, month_id_norm AS month_label, COALESCE(rfm_segment, 'Unknown') AS rfm_segment,
         CAST(SUM(CAST({_num('incremental_revenue')} AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_revenue,
         CAST(SUM(CAST({_num('customers')} AS DECIMAL(38, 6))) AS DOUBLE) AS customers,
         CAST(SUM(CAST({_num('incremental_transactions')} AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_transactions,
         CAST(SUM(CAST({_num('avg_delta_aov')} AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(*) AS avg_delta_aov
  FROM v_rfm GROUP BY month_id_norm, COALESCE(rfm_segment, 'Unknown')),
seg_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY month_id_norm ORDER BY incremental_revenue DESC, rfm_segment ASC) AS t_rn,
            ROW_NUMBER() OVER (PARTITION BY month_id_norm ORDER BY incremental_revenue ASC, rfm_segment DESC) AS b_rn
  FROM seg_month),
top_bottom AS (
  SELECT month_id_norm,
         MAX(CASE WHEN t_rn = 1 THEN rfm_segment END) AS top_segment,
         MAX(CASE WHEN t_rn = 1 THEN incremental_revenue END) AS top_rev,
         MAX(CASE WHEN b_rn = 1 THEN rfm_segment END) AS bottom_segment,
         MAX(CASE WHEN b_rn = 1 THEN incremental_revenue END) AS bottom_rev
  FROM seg_ranked GROUP BY month_id_norm),
contrib AS (
  SELECT month_id_norm, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS total_rev_net,
         CAST(SUM(CAST(CASE WHEN incremental_revenue > 0 THEN incremental_revenue ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS total_rev_pos,
         CAST(SUM(CAST(CASE WHEN incremental_revenue < 0 THEN incremental_revenue ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS total_rev_neg
  FROM seg_month GROUP BY month_id_norm),
shares AS (
  SELECT t.month_id_norm, top_segment, top_rev, total_rev_net, total_rev_pos,
         CASE WHEN total_rev_net <> 0 THEN top_rev / total_rev_net END AS share_of_net,
         CASE WHEN total_rev_pos > 0 THEN top_rev / total_rev_pos END AS share_of_positive,
         COALESCE(CASE WHEN total_rev_net <> 0 THEN top_rev / total_rev_net END > 1.0, false) AS top_exceeds_net,
         COALESCE(CASE WHEN total_rev_net <> 0 THEN top_rev / total_rev_net END < 0.0, false) AS net_negative_share
  FROM top_bottom t JOIN contrib c ON c.month_id_norm = t.month_id_norm),
active_trend AS (
  SELECT month_id_norm, month_id_norm AS month_label, CAST({_num('is_active')} AS INT) AS is_active,
         CAST(SUM(CAST({_num('customers')} AS DECIMAL(38, 6))) AS DOUBLE) AS customers,
         CAST(SUM(CAST({_num('incremental_revenue')} AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_revenue,
         CAST(SUM(CAST({_num('incremental_transactions')} AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_transactions,
         CAST(SUM(CAST({_num('avg_delta_aov')} AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(*) AS avg_delta_aov,
         CASE CAST({_num('is_active')} AS INT) WHEN 0 THEN 'Non-Active' WHEN 1 THEN 'Active' END AS active_group
  FROM v_flags GROUP BY month_id_norm, CAST({_num('is_active')} AS INT)),
"""

GOLD_VIEWS = S.gold_a() + VIEW_CTES


def q(sql: str) -> str:
    return S.with_(GOLD_VIEWS) + sql


def G(spark: SparkSession, sf_dir: str) -> Gold:
    return Gold(spark, sf_dir)


SHARE_DIGITS = {"share_of_net": 6, "share_of_positive": 6}


@register("month_fields", q("SELECT month_id, rfm_segment, customers, month_id_norm, month_id_norm AS month_label FROM v_rfm"))
def q_month_fields(spark, sf_dir):
    return V.month_fields(G(spark, sf_dir).by_rfm).select(
        "month_id", "rfm_segment", "customers", "month_id_norm", "month_label"
    )


@register(
    "month_sort_key",
    q(
        f"""SELECT month_id_norm, dash_label, {_sort_key_sql('month_id_norm')} AS key_from_norm,
  {_sort_key_sql('dash_label')} AS key_from_dash
FROM (SELECT month_id_norm, substr(month_id_norm, 1, 4) || '-' || substr(month_id_norm, 5, 2) AS dash_label FROM v_month)"""
    ),
)
def q_month_sort_key(spark, sf_dir):
    m = V.month_fields(G(spark, sf_dir).by_month).select(
        "month_id_norm",
        F.concat(F.substring("month_id_norm", 1, 4), F.lit("-"), F.substring("month_id_norm", 5, 2)).alias("dash_label"),
    )
    return m.select(
        "month_id_norm",
        "dash_label",
        month_sort_key(F.col("month_id_norm")).alias("key_from_norm"),
        month_sort_key(F.col("dash_label")).alias("key_from_dash"),
    )


@register(
    "latest_month",
    q("SELECT COUNT(DISTINCT month_id_norm) AS months, MAX(month_id_norm) AS latest_month FROM v_rfm WHERE month_id_norm <> 'Unknown'"),
)
def q_latest_month(spark, sf_dir):
    return V.latest_month(V.month_fields(G(spark, sf_dir).by_rfm))


@register(
    "latest_month_segments",
    q(
        """SELECT s.* FROM seg_month s
WHERE s.month_id_norm = (SELECT MAX(month_id_norm) FROM v_rfm WHERE month_id_norm <> 'Unknown')"""
    ),
)
def q_latest_month_segments(spark, sf_dir):
    """The segment rows of the latest month (semi join, nothing collected)."""
    return V.for_month(V.segment_month(G(spark, sf_dir).by_rfm, True))


@register(
    "headline_kpis",
    q(
        """SELECT CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS total_inc_rev, CAST(SUM(CAST(incremental_transactions AS DECIMAL(38, 6))) AS DOUBLE) AS total_inc_txn,
  CAST(SUM(CAST(avg_delta_aov AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(avg_delta_aov) AS mean_of_means_delta_aov FROM agg_month"""
    ),
)
def q_headline(spark, sf_dir):
    return V.headline(G(spark, sf_dir).by_month, True)


@register(
    "month_trend",
    q(f"SELECT month_id_norm, month_id_norm AS month_label, {_sort_key_sql('month_id_norm')} AS month_sort_key, incremental_revenue FROM v_month"),
)
def q_month_trend(spark, sf_dir):
    return V.month_trend(G(spark, sf_dir).by_month)


@register(
    "segment_ranking",
    q(
        """SELECT month_id_norm, rfm_segment, incremental_revenue, CAST(t_rn AS INT) AS segment_rank, t_rn = 1 AS is_top
FROM seg_ranked"""
    ),
)
def q_segment_ranking(spark, sf_dir):
    return V.segment_ranking(G(spark, sf_dir).by_rfm, True)


@register(
    "value_split",
    q(
        """SELECT month_id_norm, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS inc_all,
  CAST(SUM(CAST(CASE WHEN CAST(is_high_value AS INT) = 1 THEN incremental_revenue ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS inc_high_value,
  CAST(SUM(CAST(CASE WHEN CAST(is_high_value AS INT) = 0 THEN incremental_revenue ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS inc_low_value
FROM v_flags GROUP BY month_id_norm"""
    ),
)
def q_value_split(spark, sf_dir):
    return V.value_split(G(spark, sf_dir).by_flags, True)


VALUE_GROUP_SQL = "CASE CAST(is_high_value AS INT) WHEN 0 THEN 'Low Value' WHEN 1 THEN 'High Value' END"
ACTIVE_GROUP_SQL = "CASE CAST(is_active AS INT) WHEN 0 THEN 'Non-Active' WHEN 1 THEN 'Active' END"


@register(
    "by_value_group",
    q(
        f"""SELECT month_id_norm, value_group, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_revenue
FROM (SELECT *, {VALUE_GROUP_SQL} AS value_group FROM v_flags) WHERE value_group IS NOT NULL
GROUP BY month_id_norm, value_group"""
    ),
)
def q_by_value_group(spark, sf_dir):
    return V.by_value_group(G(spark, sf_dir).by_flags, True)


@register(
    "active_by_value",
    q(
        f"""SELECT month_id_norm, active_group, value_group, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_revenue,
  CAST(SUM(CAST(incremental_transactions AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_transactions,
  CAST(SUM(CAST(avg_delta_aov AS DECIMAL(38, 6))) AS DOUBLE) / COUNT(avg_delta_aov) AS avg_delta_aov, CAST(SUM(customers) AS BIGINT) AS customers
FROM (SELECT *, {VALUE_GROUP_SQL} AS value_group, {ACTIVE_GROUP_SQL} AS active_group FROM v_flags)
WHERE value_group IS NOT NULL AND active_group IS NOT NULL
GROUP BY month_id_norm, active_group, value_group"""
    ),
)
def q_active_by_value(spark, sf_dir):
    return V.active_by_value(G(spark, sf_dir).by_flags, True)


@register(
    "coerce_numeric",
    q(
        f"""SELECT month_id, rfm_segment, {_num('CAST(customers AS VARCHAR)')} AS customers_num,
  {_num('CAST(incremental_revenue AS VARCHAR)')} AS revenue_num, {_num('rfm_segment')} AS segment_num FROM agg_rfm"""
    ),
)
def q_coerce_numeric(spark, sf_dir):
    """G11 on text columns: numbers parse, labels and NULL become 0.0."""
    r = G(spark, sf_dir).by_rfm.select(
        "month_id",
        "rfm_segment",
        F.col("customers").cast("string").alias("customers_num"),
        F.col("incremental_revenue").cast("string").alias("revenue_num"),
        F.col("rfm_segment").alias("segment_num"),
    )
    return V.coerce_numeric(r, ["customers_num", "revenue_num", "segment_num"])


@register("active_trend", q("SELECT * FROM active_trend"))
def q_active_trend(spark, sf_dir):
    return V.active_trend(G(spark, sf_dir).by_flags, True)


@register(
    "active_split",
    q(
        """SELECT month_id_norm,
  CAST(SUM(CAST(CASE WHEN is_active = 1 THEN incremental_revenue ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS active_rev,
  CAST(SUM(CAST(CASE WHEN is_active = 0 THEN incremental_revenue ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS nonactive_rev,
  CAST(SUM(CAST(CASE WHEN is_active = 1 THEN incremental_transactions ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS active_txn,
  CAST(SUM(CAST(CASE WHEN is_active = 0 THEN incremental_transactions ELSE 0.0 END AS DECIMAL(38, 6))) AS DOUBLE) AS nonactive_txn
FROM active_trend GROUP BY month_id_norm"""
    ),
)
def q_active_split(spark, sf_dir):
    return V.active_split(G(spark, sf_dir).by_flags, True)


@register("segment_month", q("SELECT * FROM seg_month"))
def q_segment_month(spark, sf_dir):
    return V.segment_month(G(spark, sf_dir).by_rfm, True)


@register("contribution_split", q("SELECT * FROM contrib"))
def q_contribution(spark, sf_dir):
    return V.contribution(G(spark, sf_dir).by_rfm, True)


@register("top_bottom_segment", q("SELECT * FROM top_bottom"))
def q_top_bottom(spark, sf_dir):
    return V.top_bottom(G(spark, sf_dir).by_rfm, True)


@register(
    "segment_shares",
    q("SELECT * REPLACE (ROUND(share_of_net, 6) AS share_of_net, ROUND(share_of_positive, 6) AS share_of_positive) FROM shares"),
)
def q_shares(spark, sf_dir):
    return round_cols(V.shares(G(spark, sf_dir).by_rfm, True), SHARE_DIGITS)


@register(
    "contribution_sign",
    q(
        """SELECT month_id_norm, rfm_segment,
  CASE WHEN incremental_revenue > 0 THEN 'Positive' WHEN incremental_revenue < 0 THEN 'Negative' ELSE 'Zero' END AS contribution_sign,
  incremental_revenue, customers, incremental_transactions, avg_delta_aov FROM seg_month"""
    ),
)
def q_contribution_sign(spark, sf_dir):
    return V.contribution_sign(G(spark, sf_dir).by_rfm, True)


SEG_SRC = f"""seg_src AS (SELECT COALESCE(rfm_segment, 'Unknown') AS rfm_segment, month_id_norm AS month_label,
  {_num('incremental_revenue')} AS incremental_revenue FROM v_rfm),"""


@register(
    "segment_matrix",
    S.with_(
        GOLD_VIEWS,
        SEG_SRC,
        """grid AS (
  SELECT s.rfm_segment, m.month_label, COALESCE(x.v, 0.0) AS v
  FROM (SELECT DISTINCT rfm_segment FROM seg_src) s CROSS JOIN (SELECT DISTINCT month_label FROM seg_src) m
  LEFT JOIN (SELECT rfm_segment, month_label, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS v FROM seg_src GROUP BY 1, 2) x
    ON x.rfm_segment = s.rfm_segment AND x.month_label = m.month_label),""",
    )
    + "SELECT rfm_segment, month_label, v AS incremental_revenue FROM grid",
)
def q_segment_matrix(spark, sf_dir):
    return V.segment_matrix(G(spark, sf_dir).by_rfm, True)


@register(
    "top5_segment_trend",
    S.with_(GOLD_VIEWS, SEG_SRC)
    + """SELECT rfm_segment, month_label, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS incremental_revenue FROM seg_src
WHERE rfm_segment IN (SELECT rfm_segment FROM (SELECT rfm_segment, CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) AS DOUBLE) AS tot FROM seg_src
                      GROUP BY rfm_segment ORDER BY tot DESC, rfm_segment ASC LIMIT 5))
GROUP BY rfm_segment, month_label""",
)
def q_top5(spark, sf_dir):
    return V.top_n_trend(G(spark, sf_dir).by_rfm, 5, True)


# ---------------------------------------------------------------- diagnostics

FACT_M = "fm AS (SELECT *, COALESCE(CAST(month_id AS VARCHAR), 'Unknown') AS month_id_norm FROM fact),"


def qd(sql: str, *extra: str) -> str:
    return S.with_(S.chain_a(), FACT_M, *extra) + sql


@register(
    "coverage",
    qd(
        """SELECT month_id_norm, COUNT(*) AS row_count, COUNT(DISTINCT customer_id) AS customers,
  CAST(SUM(CASE WHEN pre_revenue = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_pre,
  CAST(SUM(CASE WHEN post_revenue = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_post,
  ROUND(quantile_cont(incremental_revenue, 0.5), 6) AS median_inc_rev
FROM fm GROUP BY month_id_norm"""
    ),
)
def q_coverage(spark, sf_dir):
    return round_cols(diagnostics.coverage(G(spark, sf_dir).lifts), {"median_inc_rev": 6})


@register(
    "lift_histogram",
    qd(
        """SELECT month_id_norm, bin, ROUND(lo + (bin - 1) * (hi - lo) / 60, 6) + 0.0 AS bin_start,
  ROUND(lo + bin * (hi - lo) / 60, 6) + 0.0 AS bin_end, COUNT(*) AS row_count
FROM (SELECT month_id_norm, lo, hi,
        CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE LEAST(FLOOR((x - lo) / (hi - lo) * 60) + 1, 60) END AS INT) AS bin
      FROM (SELECT month_id_norm, incremental_revenue AS x,
                   MIN(incremental_revenue) OVER (PARTITION BY month_id_norm) AS lo,
                   MAX(incremental_revenue) OVER (PARTITION BY month_id_norm) AS hi FROM fm))
GROUP BY month_id_norm, bin, lo, hi"""
    ),
)
def q_histogram(spark, sf_dir):
    h = diagnostics.histogram(G(spark, sf_dir).lifts, 60)
    return round_cols(h, {"bin_start": 6, "bin_end": 6})


@register(
    "rate_unpivot",
    qd(
        """SELECT customer_id, month_id_norm, 'pre_rev_per_day' AS period, ROUND(pre_rev_per_day, 6) AS rev_per_day FROM fm
UNION ALL SELECT customer_id, month_id_norm, 'post_rev_per_day', ROUND(post_rev_per_day, 6) FROM fm"""
    ),
)
def q_rate_unpivot(spark, sf_dir):
    return round_cols(diagnostics.rate_unpivot(G(spark, sf_dir).lifts), {"rev_per_day": 6})


BOX = {"min": 6, "q1": 6, "median": 6, "q3": 6, "max": 6}


@register(
    "rate_box",
    qd(
        """SELECT month_id_norm, period, ROUND(MIN(v), 6) AS min, ROUND(MAX(v), 6) AS max,
  ROUND(quantile_cont(v, 0.25), 6) AS q1, ROUND(quantile_cont(v, 0.5), 6) AS median, ROUND(quantile_cont(v, 0.75), 6) AS q3
FROM (SELECT month_id_norm, 'pre_rev_per_day' AS period, pre_rev_per_day AS v FROM fm
      UNION ALL SELECT month_id_norm, 'post_rev_per_day', post_rev_per_day FROM fm)
GROUP BY month_id_norm, period"""
    ),
)
def q_rate_box(spark, sf_dir):
    return round_cols(diagnostics.rate_box(G(spark, sf_dir).lifts), BOX)


def _outlier_sql(order: str) -> str:
    return qd(
        f"""SELECT customer_id, month_label, ROUND(incremental_revenue, 6) AS incremental_revenue,
  ROUND(pre_revenue, 6) AS pre_revenue, ROUND(post_revenue, 6) AS post_revenue, CAST(outlier_rank AS INT) AS outlier_rank
FROM (SELECT *, month_id_norm AS month_label,
        ROW_NUMBER() OVER (PARTITION BY month_id_norm ORDER BY incremental_revenue {order}, customer_id ASC) AS outlier_rank
      FROM fm) WHERE outlier_rank <= 20"""
    )


OUT_DIGITS = {"incremental_revenue": 6, "pre_revenue": 6, "post_revenue": 6}


@register("outliers_top", _outlier_sql("DESC"))
def q_outliers_top(spark, sf_dir):
    return round_cols(diagnostics.outliers(G(spark, sf_dir).lifts, 20, top=True), OUT_DIGITS)


@register("outliers_bottom", _outlier_sql("ASC"))
def q_outliers_bottom(spark, sf_dir):
    return round_cols(diagnostics.outliers(G(spark, sf_dir).lifts, 20, top=False), OUT_DIGITS)


@register(
    "stage_audit",
    S.with_(GOLD_VIEWS)
    + """SELECT 'exposures' AS stage, COUNT(*) AS row_count FROM fact_crm_exposure
UNION ALL SELECT 'anchors', COUNT(*) FROM anchors
UNION ALL SELECT 'fact', COUNT(*) FROM fact
UNION ALL SELECT 'rfm', COUNT(*) FROM rfm
UNION ALL SELECT 'agg_month', COUNT(*) FROM agg_month
UNION ALL SELECT 'agg_rfm', COUNT(*) FROM agg_rfm
UNION ALL SELECT 'agg_flags', COUNT(*) FROM agg_flags""",
)
def q_stage_audit(spark, sf_dir):
    g = G(spark, sf_dir)
    return diagnostics.stage_audit(
        {
            "exposures": g.binding.exposures,
            "anchors": g.anchors,
            "fact": g.fact,
            "rfm": g.rfm,
            "agg_month": grains.by_month(g.rolled),
            "agg_rfm": grains.by_rfm(g.rolled),
            "agg_flags": grains.by_flags(g.rolled),
        }
    )


# ---------------------------------------------------------------- dense (events) binding

FACT_MB = "fm AS (SELECT *, COALESCE(CAST(month_id AS VARCHAR), 'Unknown') AS month_id_norm FROM fact),"


def _events_fact(spark, sf_dir):
    from beforeafter.plans.queries_core import EVENTS_CFG

    return chain(spark, sf_dir, EVENTS_CFG, "b").fact


@register(
    "coverage_events",
    S.with_(S.chain_b(14, 7), FACT_MB)
    + """SELECT month_id_norm, COUNT(*) AS row_count, COUNT(DISTINCT customer_id) AS customers,
  CAST(SUM(CASE WHEN pre_revenue = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_pre,
  CAST(SUM(CASE WHEN post_revenue = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_post,
  ROUND(quantile_cont(incremental_revenue, 0.5), 6) AS median_inc_rev
FROM fm GROUP BY month_id_norm""",
)
def q_coverage_events(spark, sf_dir):
    """G22 on the dense events binding (PRE 14 / POST 7)."""
    return round_cols(diagnostics.coverage(_events_fact(spark, sf_dir)), {"median_inc_rev": 6})


def _outlier_sql_b(order: str) -> str:
    return S.with_(S.chain_b(14, 7), FACT_MB) + f"""SELECT customer_id, month_label, ROUND(incremental_revenue, 6) AS incremental_revenue,
  ROUND(pre_revenue, 6) AS pre_revenue, ROUND(post_revenue, 6) AS post_revenue, CAST(outlier_rank AS INT) AS outlier_rank
FROM (SELECT *, month_id_norm AS month_label,
        ROW_NUMBER() OVER (PARTITION BY month_id_norm ORDER BY incremental_revenue {order}, customer_id ASC) AS outlier_rank
      FROM fm) WHERE outlier_rank <= 20"""


@register("outliers_top_events", _outlier_sql_b("DESC"))
def q_outliers_top_events(spark, sf_dir):
    """G25 on the dense events binding."""
    return round_cols(diagnostics.outliers(_events_fact(spark, sf_dir), 20, top=True), OUT_DIGITS)


@register("outliers_bottom_events", _outlier_sql_b("ASC"))
def q_outliers_bottom_events(spark, sf_dir):
    return round_cols(diagnostics.outliers(_events_fact(spark, sf_dir), 20, top=False), OUT_DIGITS)
