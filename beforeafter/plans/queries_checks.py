"""Queries for validation (J1-J12) and bias controls (K1-K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from beforeafter.config import SENSITIVITY_POST_DAYS, SENSITIVITY_PRE_DAYS
from beforeafter.functions.numeric import rsum
from beforeafter.operators import bias, checks, grains, measures, sensitivity, summary
from beforeafter.plans import sql as S
from beforeafter.plans.present import round_cols
from beforeafter.plans.queries_core import chain
from beforeafter.plans.queries_views import FACT_M, GOLD_VIEWS, G
from beforeafter.plans.registry import register
from beforeafter.session import materialize
from beforeafter.sources.bindings import binding_a

MONTH_KEY_SQL = S.month_key("month_id")
xsum, xavg = S.xsum, S.xavg


def _unique_sql(table: str, keys: str) -> str:
    return f"""SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS row_count, COUNT(*) AS distinct_keys,
  COUNT(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys, COUNT(CASE WHEN n > 1 THEN 1 END) = 0 AS passed
FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys})"""


# ---------------------------------------------------------------- J


@register("check_unique_fact", S.with_(S.chain_a()) + _unique_sql("fact", "customer_id, month_id"))
def q_check_unique_fact(spark, sf_dir):
    """One row per customer and month in the fact."""
    return checks.unique(chain(spark, sf_dir, flags=False).fact, ["customer_id", "month_id"])


@register("check_unique_tx", S.with_(S.BINDING_A) + _unique_sql("fact_transaction", "transaction_id"))
def q_check_unique_tx(spark, sf_dir):
    """Duplicate transaction ids (they would inflate revenue only)."""
    return checks.unique(binding_a(spark, sf_dir).transactions, ["transaction_id"])


@register(
    "check_duplicate_exposures",
    S.with_(
        S.BINDING_A,
        """per_day AS (SELECT customer_id, month_id, exposure_date, COUNT(*) AS n FROM fact_crm_exposure
  GROUP BY customer_id, month_id, exposure_date),
per_anchor AS (SELECT customer_id, month_id, arg_min(n, exposure_date) AS on_anchor FROM per_day GROUP BY customer_id, month_id),
ids AS (SELECT COUNT(*) AS duplicate_exposure_ids FROM (SELECT exposure_id FROM fact_crm_exposure GROUP BY exposure_id HAVING COUNT(*) > 1)),""",
    )
    + """SELECT a.*, ids.duplicate_exposure_ids, a.anchors_with_duplicates = 0 AND ids.duplicate_exposure_ids = 0 AS passed
FROM (SELECT COUNT(*) AS anchors, COUNT(CASE WHEN on_anchor > 1 THEN 1 END) AS anchors_with_duplicates,
             CAST(MAX(on_anchor) AS BIGINT) AS max_contacts_on_anchor_day FROM per_anchor) a CROSS JOIN ids""",
)
def q_check_duplicate_exposures(spark, sf_dir):
    """Several contacts on an anchor day; contact ids used twice."""
    return checks.duplicate_exposures(binding_a(spark, sf_dir).exposures)


def _numeric_sql() -> str:
    parts = []
    for name, expr in (
        ("customers", "CAST(customers AS VARCHAR)"),
        ("incremental_revenue", "CAST(incremental_revenue AS VARCHAR)"),
        ("rfm_segment", "rfm_segment"),
    ):
        parts.append(
            f"SELECT '{name}' AS column_name, COUNT({expr}) AS value_count, "
            f"COUNT(CASE WHEN {expr} IS NOT NULL AND TRY_CAST({expr} AS DOUBLE) IS NULL THEN 1 END) AS non_numeric FROM agg_rfm"
        )
    body = "\nUNION ALL ".join(parts)
    return S.with_(GOLD_VIEWS) + f"SELECT *, non_numeric = 0 AS passed FROM ({body})"


@register("check_numeric", _numeric_sql())
def q_check_numeric(spark, sf_dir):
    """Exported summary columns that must be numbers (the segment is text)."""
    r = G(spark, sf_dir).by_rfm.select(
        F.col("customers").cast("string").alias("customers"),
        F.col("incremental_revenue").cast("string").alias("incremental_revenue"),
        "rfm_segment",
    )
    return checks.numeric(r, ["customers", "incremental_revenue", "rfm_segment"])


def _roll_sql(table: str, cust: str, tag: str) -> str:
    return (
        f"SELECT month_id, CAST(SUM({cust}) AS BIGINT) AS customers_{tag}, {xsum('incremental_revenue')} AS revenue_{tag}, "
        f"{xsum('incremental_transactions')} AS transactions_{tag} FROM {table} GROUP BY month_id"
    )


def _close(a: str, b: str) -> str:
    return f"COALESCE(abs({a} - {b}) <= 0.001, false)"


@register(
    "check_reconcile",
    S.with_(GOLD_VIEWS)
    + f"""SELECT *, {_close('customers_month', 'customers_rfm')} AND {_close('customers_month', 'customers_flags')}
  AND {_close('revenue_month', 'revenue_rfm')} AND {_close('revenue_month', 'revenue_flags')}
  AND {_close('transactions_month', 'transactions_rfm')} AND {_close('transactions_month', 'transactions_flags')} AS passed
FROM ({_roll_sql('agg_month', 'exposed_customer_months', 'month')}) m
FULL OUTER JOIN ({_roll_sql('agg_rfm', 'customers', 'rfm')}) r USING (month_id)
FULL OUTER JOIN ({_roll_sql('agg_flags', 'customers', 'flags')}) f USING (month_id)""",
)
def q_check_reconcile(spark, sf_dir):
    """Month totals equal the sums over segments and over flags, all from one
    pass over the fact."""
    r = G(spark, sf_dir).rolled
    return checks.reconcile(grains.by_month(r), grains.by_rfm(r), grains.by_flags(r), exact=True)


@register(
    "check_windows",
    S.with_(S.chain_a())
    + f"""SELECT COUNT(*) AS row_count,
  COUNT(CASE WHEN date_diff('day', pre_start, pre_end) + 1 <> 28 OR CAST(pre_end + INTERVAL 1 DAY AS DATE) <> anchor_exposure_date THEN 1 END) AS bad_pre_window,
  COUNT(CASE WHEN date_diff('day', post_start, post_end) + 1 <> 7 OR post_start <> anchor_exposure_date THEN 1 END) AS bad_post_window,
  COUNT(CASE WHEN anchor_exposure_date IS NULL OR CAST(strftime(anchor_exposure_date, '%Y%m') AS INT) <> COALESCE({MONTH_KEY_SQL}, -1) THEN 1 END) AS anchor_month_mismatch
FROM pre_post""".replace("SELECT COUNT(*) AS row_count", "SELECT *, bad_pre_window = 0 AND bad_post_window = 0 AND anchor_month_mismatch = 0 AS passed FROM (SELECT COUNT(*) AS row_count", 1)
    + ")",
)
def q_check_windows(spark, sf_dir):
    """Window lengths, placement around the anchor, anchor in its month."""
    return checks.windows(chain(spark, sf_dir).pre_post, 28, 7)


@register(
    "check_no_activity",
    S.with_(S.chain_a(), FACT_M)
    + """SELECT month_id_norm, COUNT(*) AS row_count, COUNT(CASE WHEN pre_txn_cnt = 0 THEN 1 END) AS no_pre,
  COUNT(CASE WHEN post_txn_cnt = 0 THEN 1 END) AS no_post,
  COUNT(CASE WHEN pre_txn_cnt = 0 AND post_txn_cnt = 0 THEN 1 END) AS no_pre_no_post
FROM fm GROUP BY month_id_norm""",
)
def q_check_no_activity(spark, sf_dir):
    """Customer-months without PRE or POST purchases."""
    return checks.no_activity(chain(spark, sf_dir, flags=False).fact)


@register(
    "zero_shares",
    S.with_(S.chain_a(), FACT_M)
    + """SELECT *, ROUND(zero_pre / row_count, 6) AS zero_pre_share, ROUND(zero_post / row_count, 6) AS zero_post_share
FROM (SELECT month_id_norm, COUNT(*) AS row_count, COUNT(CASE WHEN pre_revenue = 0 THEN 1 END) AS zero_pre,
  COUNT(CASE WHEN post_revenue = 0 THEN 1 END) AS zero_post FROM fm GROUP BY month_id_norm)""",
)
def q_zero_shares(spark, sf_dir):
    """Share of rows with zero PRE and zero POST revenue per month."""
    return round_cols(checks.zero_shares(chain(spark, sf_dir, flags=False).fact), {"zero_pre_share": 6, "zero_post_share": 6})


# ---------------------------------------------------------------- J7 / J8


def _grid_sql() -> str:
    lo, hi = max(SENSITIVITY_PRE_DAYS), max(SENSITIVITY_POST_DAYS) - 1
    cols = []
    for p in SENSITIVITY_PRE_DAYS:
        cond = f"d BETWEEN CAST(a - INTERVAL {p} DAY AS DATE) AND CAST(a - INTERVAL 1 DAY AS DATE)"
        cols += [
            f"COALESCE(SUM(CASE WHEN {cond} THEN revenue END), 0.0) AS pre{p}_rev",
            f"COUNT(DISTINCT CASE WHEN {cond} THEN tid END) AS pre{p}_txn",
        ]
    for q in SENSITIVITY_POST_DAYS:
        cond = f"d BETWEEN a AND CAST(a + INTERVAL {q - 1} DAY AS DATE)"
        cols += [
            f"COALESCE(SUM(CASE WHEN {cond} THEN revenue END), 0.0) AS post{q}_rev",
            f"COUNT(DISTINCT CASE WHEN {cond} THEN tid END) AS post{q}_txn",
        ]
    longs = []
    for p in SENSITIVITY_PRE_DAYS:
        for q in SENSITIVITY_POST_DAYS:
            longs.append(
                f"SELECT customer_id, month_id, {p} AS pre_days, {q} AS post_days, "
                f"(post{q}_rev / {q} - pre{p}_rev / {p}) * {q} AS incremental_revenue, "
                f"(post{q}_txn / {q} - pre{p}_txn / {p}) * {q} AS incremental_transactions FROM sg_w"
            )
    return f"""
sg_j AS (SELECT a.customer_id, a.month_id, a.anchor_exposure_date AS a, t.transaction_date AS d, t.transaction_id AS tid, t.revenue
  FROM anchors a LEFT JOIN fact_transaction t ON t.customer_id = a.customer_id
   AND t.transaction_date BETWEEN CAST(a.anchor_exposure_date - INTERVAL {lo} DAY AS DATE)
                              AND CAST(a.anchor_exposure_date + INTERVAL {hi} DAY AS DATE)),
sg_w AS (SELECT customer_id, month_id, {", ".join(cols)} FROM sg_j
  WHERE customer_id IN (SELECT customer_id FROM dim_customer) GROUP BY customer_id, month_id, a),
sg_long AS ({" UNION ALL ".join(longs)}),
"""


GRID_SQL = _grid_sql()


@register(
    "sensitivity_grid",
    S.with_(S.gold_a(), GRID_SQL)
    + f"""SELECT pre_days, post_days, COUNT(*) AS customer_months, {xsum('incremental_revenue')} AS incremental_revenue,
  {xsum('incremental_transactions')} AS incremental_transactions FROM sg_long GROUP BY pre_days, post_days""",
)
def q_sensitivity_grid(spark, sf_dir):
    """PRE 14/28/56 x POST 3/7/14 from running totals, one lookup per window edge."""
    g = G(spark, sf_dir)
    return sensitivity.grid(sensitivity.per_anchor(g.anchors, g.days, g.binding.customer_ids), exact=True)


SEG_GRID_SQL = f"""seg_grid AS (SELECT COALESCE(r.rfm_segment, 'Unknown') AS rfm_segment, g.pre_days, g.post_days,
  COUNT(*) AS customer_months, {xsum('g.incremental_revenue')} AS incremental_revenue,
  {xsum('g.incremental_transactions')} AS incremental_transactions
  FROM sg_long g LEFT JOIN rfm r ON r.customer_id = g.customer_id AND r.month_id = g.month_id
  GROUP BY COALESCE(r.rfm_segment, 'Unknown'), g.pre_days, g.post_days),"""


def _seg_grid(spark, sf_dir):
    """The stored window totals, one row per anchor, and the grid per segment: the
    segment is looked up before an anchor becomes its nine pairs."""
    g = G(spark, sf_dir)
    found = materialize(sensitivity.totals(g.anchors, g.days, g.binding.customer_ids), "sensitivity")
    long = sensitivity.stacked(measures.with_segment(found, g.rfm), keys=["rfm_segment"])
    return found, sensitivity.grid(long, by=["rfm_segment"], exact=True)


@register("sensitivity_by_segment", S.with_(S.gold_a(), GRID_SQL, SEG_GRID_SQL) + "SELECT * FROM seg_grid")
def q_sensitivity_by_segment(spark, sf_dir):
    """J7 per RFM segment."""
    return _seg_grid(spark, sf_dir)[1]


@register(
    "sensitivity_sign_flips",
    S.with_(
        S.gold_a(),
        GRID_SQL,
        SEG_GRID_SQL,
        f"""tot_grid AS (SELECT pre_days, post_days, {xsum('incremental_revenue')} AS incremental_revenue
  FROM sg_long GROUP BY pre_days, post_days),""",
    )
    + """SELECT *, NOT (n_positive > 0 AND n_negative > 0) AS stable FROM (
  SELECT rfm_segment, COUNT(CASE WHEN incremental_revenue > 0 THEN 1 END) AS n_positive,
         COUNT(CASE WHEN incremental_revenue < 0 THEN 1 END) AS n_negative,
         COUNT(CASE WHEN incremental_revenue = 0 THEN 1 END) AS n_zero FROM seg_grid GROUP BY rfm_segment
  UNION ALL
  SELECT 'ALL', COUNT(CASE WHEN incremental_revenue > 0 THEN 1 END), COUNT(CASE WHEN incremental_revenue < 0 THEN 1 END),
         COUNT(CASE WHEN incremental_revenue = 0 THEN 1 END) FROM tot_grid)""",
)
def q_sensitivity_sign_flips(spark, sf_dir):
    """Does the direction of lift hold over the grid, per segment and overall?"""
    found, seg_grid = _seg_grid(spark, sf_dir)
    per_seg = sensitivity.stability(seg_grid, by=["rfm_segment"])
    overall = sensitivity.stability(sensitivity.grid(sensitivity.stacked(found), exact=True)).select(
        F.lit("ALL").alias("rfm_segment"), "n_positive", "n_negative", "n_zero", "stable"
    )
    return per_seg.unionByName(overall)


@register(
    "final_gate",
    S.with_(
        S.gold_a(),
        GRID_SQL,
        f"""tot_grid AS (SELECT pre_days, post_days, {xsum('incremental_revenue')} AS r FROM sg_long GROUP BY ALL),
seg_total AS (SELECT COALESCE(rfm_segment, 'Unknown') AS s, {xsum('incremental_revenue')} AS r FROM agg_rfm GROUP BY 1),""",
    )
    + """SELECT grid_positive, grid_negative, negative_segments, negative_count,
  NOT (grid_positive > 0 AND grid_negative > 0) AS direction_stable
FROM (SELECT COUNT(*) FILTER (WHERE r > 0) AS grid_positive, COUNT(*) FILTER (WHERE r < 0) AS grid_negative FROM tot_grid),
     (SELECT COALESCE(string_agg(s, ', ' ORDER BY s) FILTER (WHERE r < 0), '') AS negative_segments,
             COUNT(*) FILTER (WHERE r < 0) AS negative_count FROM seg_total)""",
)
def q_final_gate(spark, sf_dir):
    """Direction over the sensitivity grid and negative segments, in one row."""
    g = G(spark, sf_dir)
    long = sensitivity.per_anchor(g.anchors, g.days, g.binding.customer_ids)
    segments = (
        summary.by_rfm(g.lifts, g.rfm, exact=True)  # no flags are read
        .withColumn("rfm_segment", F.coalesce("rfm_segment", F.lit("Unknown")))
        .groupBy("rfm_segment")
        .agg(rsum("incremental_revenue", exact=True).alias("incremental_revenue"))
    )
    return checks.final_gate(sensitivity.grid(long, exact=True), segments)


#: Months above this share of rows with an empty side are left out.
MOST_ZERO = 0.97


@register(
    "summary_without_zero_months",
    S.with_(
        S.chain_a(),
        FACT_M,
        f"""sparse AS (SELECT month_id_norm FROM fm GROUP BY 1
  HAVING GREATEST(AVG(CAST(pre_revenue = 0 AS INT)), AVG(CAST(post_revenue = 0 AS INT))) > {MOST_ZERO}),""",
    )
    + f"""SELECT month_key_yyyymm AS month_id, COUNT(DISTINCT customer_id) AS exposed_customer_months,
  {xsum('incremental_revenue')} AS incremental_revenue, {xsum('incremental_transactions')} AS incremental_transactions,
  {xavg('delta_aov')} AS avg_delta_aov
FROM fm WHERE month_id_norm NOT IN (SELECT month_id_norm FROM sparse) GROUP BY 1""",
)
def q_summary_without_zero_months(spark, sf_dir):
    """The month summary without months whose zero shares are high."""
    return summary.by_month(checks.without_zero_months(G(spark, sf_dir).lifts, MOST_ZERO), exact=True)


# ---------------------------------------------------------------- K


@register(
    "rolling_lift",
    S.with_(GOLD_VIEWS)
    + """SELECT month_id, incremental_revenue,
  CAST(SUM(CAST(incremental_revenue AS DECIMAL(38, 6))) OVER w AS DOUBLE) AS rolling_revenue,
  CAST(SUM(CAST(incremental_transactions AS DECIMAL(38, 6))) OVER w AS DOUBLE) AS rolling_transactions,
  CAST(SUM(CAST(avg_delta_aov AS DECIMAL(38, 6))) OVER w AS DOUBLE) / COUNT(avg_delta_aov) OVER w AS rolling_mean_delta_aov,
  COUNT(*) OVER w AS months_in_window
FROM agg_month WINDOW w AS (ORDER BY month_id ASC NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def q_rolling_lift(spark, sf_dir):
    """K1: three-month rolling lift."""
    return bias.rolling(G(spark, sf_dir).by_month, 3, exact=True)


HEAVY_SQL = """
monthly AS (SELECT CAST(date_trunc('month', exposure_date) AS DATE) AS period_start, COUNT(*) AS contacts
  FROM fact_crm_exposure WHERE exposure_date IS NOT NULL GROUP BY 1),
heavy AS (SELECT period_start, last_day(period_start) AS period_end, contacts FROM monthly
  WHERE contacts >= (SELECT quantile_cont(contacts, 0.9) FROM monthly)),
fact_flag AS (SELECT f.*, EXISTS (SELECT 1 FROM heavy h
    WHERE CAST(f.anchor_exposure_date - INTERVAL 28 DAY AS DATE) <= h.period_end
      AND CAST(f.anchor_exposure_date + INTERVAL 6 DAY AS DATE) >= h.period_start) AS in_promo FROM fact f),
"""


@register("heavy_periods", S.with_(S.chain_a(), HEAVY_SQL) + "SELECT * FROM heavy")
def q_heavy_periods(spark, sf_dir):
    """K2 input: months whose contact volume is at the 90th percentile or above."""
    return bias.heavy_periods(binding_a(spark, sf_dir).exposures)


@register(
    "exclude_promo",
    S.with_(S.chain_a(), HEAVY_SQL)
    + f"""SELECT month_key_yyyymm AS month_id, COUNT(DISTINCT customer_id) AS exposed_customer_months,
  {xsum('incremental_revenue')} AS incremental_revenue, {xsum('incremental_transactions')} AS incremental_transactions,
  {xavg('delta_aov')} AS avg_delta_aov
FROM fact_flag WHERE NOT in_promo GROUP BY month_key_yyyymm""",
)
def q_exclude_promo(spark, sf_dir):
    """K2: month summary without customer-months whose windows touch heavy contact months."""
    c = chain(spark, sf_dir)
    kept = bias.exclude_periods(c.fact, bias.heavy_periods(c.binding.exposures))
    return summary.by_month(kept, exact=True)


@register(
    "promo_vs_quiet",
    S.with_(S.chain_a(), HEAVY_SQL)
    + f"""SELECT CASE WHEN in_promo THEN 'promo' ELSE 'quiet' END AS period_flag, COUNT(*) AS customer_months,
  {xsum('incremental_revenue')} AS incremental_revenue, {xsum('incremental_transactions')} AS incremental_transactions,
  {xavg('delta_aov')} AS avg_delta_aov
FROM fact_flag GROUP BY 1""",
)
def q_promo_vs_quiet(spark, sf_dir):
    """K3: lift in heavy contact periods against quiet periods."""
    c = chain(spark, sf_dir)
    ann = bias.annotate_periods(c.fact, bias.heavy_periods(c.binding.exposures))
    return bias.compare_periods(ann, exact=True)


def _decay_sql(horizon: int) -> str:
    return f"""SELECT o.day_offset, COALESCE(x.revenue, 0.0) AS revenue, COALESCE(x.purchase_rows, 0) AS purchase_rows,
  COALESCE(x.buying_customer_months, 0) AS buying_customer_months
FROM (SELECT CAST(range AS INT) AS day_offset FROM range(0, {horizon})) o
LEFT JOIN (
  SELECT day_offset, {xsum('revenue')} AS revenue, COUNT(*) AS purchase_rows,
         COUNT(DISTINCT customer_id || '|' || COALESCE(CAST(month_id AS VARCHAR), '')) AS buying_customer_months
  FROM (SELECT a.customer_id, a.month_id, CAST(date_diff('day', a.anchor_exposure_date, t.transaction_date) AS INT) AS day_offset,
               t.revenue FROM anchors a JOIN fact_transaction t ON t.customer_id = a.customer_id
         AND t.transaction_date BETWEEN a.anchor_exposure_date AND CAST(a.anchor_exposure_date + INTERVAL {horizon - 1} DAY AS DATE))
  GROUP BY day_offset) x ON x.day_offset = o.day_offset"""


@register("post_decay", S.with_(S.chain_a()) + _decay_sql(28))
def q_post_decay(spark, sf_dir):
    """K4: purchases by day after the anchor over 28 days (orders binding)."""
    c = chain(spark, sf_dir)
    return bias.decay(c.anchors, c.days, 28, exact=True)


@register("post_decay_events", S.with_(S.chain_b()) + _decay_sql(14))
def q_post_decay_events(spark, sf_dir):
    """K4 on the dense events binding, 14 days."""
    b_chain = chain(spark, sf_dir, which="b")
    return bias.decay(b_chain.anchors, b_chain.days, 14, exact=True)


@register(
    "summary_rfm_frozen",
    S.with_(
        S.gold_a(),
        """rfm_next AS (SELECT customer_id, rfm_segment AS frozen_segment,
  CAST(strftime(CAST(TRY_STRPTIME(CAST(month_id AS VARCHAR) || '01', '%Y%m%d') AS DATE) + INTERVAL 1 MONTH, '%Y%m') AS INT) AS next_key
  FROM rfm WHERE customer_id IS NOT NULL AND length(CAST(month_id AS VARCHAR)) = 6),""",
    )
    + f"""SELECT f.month_key_yyyymm AS month_id, r.frozen_segment, COUNT(DISTINCT f.customer_id) AS customers,
  {xsum('f.incremental_revenue')} AS incremental_revenue, {xsum('f.incremental_transactions')} AS incremental_transactions,
  {xavg('f.delta_aov')} AS avg_delta_aov
FROM fact f LEFT JOIN rfm_next r ON r.customer_id = f.customer_id AND r.next_key = f.month_key_yyyymm
GROUP BY f.month_key_yyyymm, r.frozen_segment""",
)
def q_summary_rfm_frozen(spark, sf_dir):
    """K5: segment summary with the segment frozen as of the previous month end."""
    g = G(spark, sf_dir)
    return bias.summary_frozen(g.fact, g.rfm, exact=True)


@register(
    "segment_transitions",
    S.with_(S.gold_a())
    + f"""SELECT month_key, from_segment, to_segment, COUNT(*) AS customers FROM (
  SELECT month_key, rfm_segment AS to_segment, LAG(rfm_segment) OVER w AS from_segment, LAG(month_key) OVER w AS pk
  FROM (SELECT customer_id, rfm_segment, {MONTH_KEY_SQL} AS month_key FROM rfm WHERE customer_id IS NOT NULL)
  WHERE month_key IS NOT NULL
  WINDOW w AS (PARTITION BY customer_id ORDER BY month_key))
WHERE pk = CAST(strftime(CAST(TRY_STRPTIME(CAST(month_key AS VARCHAR) || '01', '%Y%m%d') AS DATE) - INTERVAL 1 MONTH, '%Y%m') AS INT)
GROUP BY month_key, from_segment, to_segment""",
)
def q_segment_transitions(spark, sf_dir):
    """K6: segment moves between consecutive months."""
    return bias.transitions(G(spark, sf_dir).rfm)
