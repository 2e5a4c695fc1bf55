"""Bias controls and checks on hand-made frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from beforeafter.operators import bias, checks, windows


def _stream(spark, rows):
    tx = spark.createDataFrame(rows, "transaction_id long, customer_id long, transaction_date date, revenue double")
    return windows.purchase_days(tx)


def test_decay_offsets_zero_filled(spark):
    a = spark.createDataFrame([(1, 202503, dt.date(2025, 3, 10))], "customer_id long, month_id int, anchor_exposure_date date")
    days = _stream(spark, [(1, 1, dt.date(2025, 3, 10), 5.0), (2, 1, dt.date(2025, 3, 12), 2.0),
                           (3, 1, dt.date(2025, 3, 12), 1.0), (4, 1, dt.date(2025, 3, 9), 9.0)])
    d = {r.day_offset: r for r in bias.decay(a, days, 5).collect()}
    assert sorted(d) == [0, 1, 2, 3, 4]
    assert (d[0].revenue, d[0].purchase_rows, d[0].buying_customer_months) == (5.0, 1, 1)
    assert (d[2].revenue, d[2].purchase_rows) == (3.0, 2)
    assert d[1].revenue == 0.0 and d[1].buying_customer_months == 0


def test_transitions_need_consecutive_months(spark):
    rfm = spark.createDataFrame(
        [(1, 202501, "Lost"), (1, 202502, "Loyal"), (1, 202504, "Champions"), (2, 202512, "At Risk"),
         (2, 202601, "Others"), (None, 202502, "At Risk")],
        "customer_id long, month_id int, rfm_segment string",
    )
    t = {(r.month_key, r.from_segment, r.to_segment): r.customers for r in bias.transitions(rfm).collect()}
    assert t == {(202502, "Lost", "Loyal"): 1, (202601, "At Risk", "Others"): 1}


def test_frozen_segment_is_previous_month(spark):
    fact = spark.createDataFrame(
        [(1, 202502, 202502, 3.0, 1.0, 0.5)],
        "customer_id long, month_id int, month_key_yyyymm int, incremental_revenue double, "
        "incremental_transactions double, delta_aov double",
    )
    rfm = spark.createDataFrame([(1, 202501, "Lost"), (1, 202502, "Loyal")], "customer_id long, month_id int, rfm_segment string")
    assert [r.frozen_segment for r in bias.frozen_segments(fact, rfm).collect()] == ["Lost"]


def test_heavy_periods_and_exclusion(spark):
    ex = spark.createDataFrame(
        [(i, dt.date(2025, 1 + (i % 3), 5)) for i in range(12)] + [(100 + i, dt.date(2025, 6, 1)) for i in range(40)],
        "exposure_id long, exposure_date date",
    )
    periods = bias.heavy_periods(ex, 0.9)
    assert [(r.period_start, r.period_end) for r in periods.collect()] == [(dt.date(2025, 6, 1), dt.date(2025, 6, 30))]
    fact = spark.createDataFrame(
        [(1, dt.date(2025, 5, 28)), (2, dt.date(2025, 7, 28)), (3, dt.date(2025, 7, 29)), (4, dt.date(2025, 3, 1))],
        "customer_id long, anchor_exposure_date date",
    )
    # PRE starts 28 days before the anchor: 2025-07-28 reaches back to 2025-06-30.
    kept = sorted(r.customer_id for r in bias.exclude_periods(fact, periods).collect())
    assert kept == [3, 4]
    flags = {r.customer_id: r.period_flag for r in bias.annotate_periods(fact, periods).collect()}
    assert flags == {1: "promo", 2: "promo", 3: "quiet", 4: "quiet"}


def test_unique_and_reconcile(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1)], "a long, b int")
    u = checks.unique(df, ["a", "b"]).first()
    assert (u.row_count, u.distinct_keys, u.duplicate_keys, u.passed) == (4, 3, 1, False)
    m = spark.createDataFrame([(1, 5, 2.0, 1.0)], "month_id int, exposed_customer_months long, incremental_revenue double, incremental_transactions double")
    r = spark.createDataFrame([(1, 3, 1.5, 0.5), (1, 2, 0.5, 0.5), (2, 1, 1.0, 1.0)],
                              "month_id int, customers long, incremental_revenue double, incremental_transactions double")
    rec = {x.month_id: x.passed for x in checks.reconcile(m, r, r.select("*")).collect()}
    assert rec == {1: True, 2: False}
    assert F is not None
