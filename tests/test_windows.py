"""Anchors and PRE/POST windows on hand-made frames, against brute force."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Row

from beforeafter.config import LiftConfig
from beforeafter.operators import lift, windows

D0 = dt.date(2025, 3, 10)


def d(off: int) -> dt.date:
    return D0 + dt.timedelta(days=off)


def _tx(spark, rows):
    return spark.createDataFrame(
        [Row(transaction_id=t, customer_id=c, transaction_date=day, revenue=r) for t, c, day, r in rows],
        "transaction_id long, customer_id long, transaction_date date, revenue double",
    )


def _ex(spark, rows):
    return spark.createDataFrame(
        [Row(exposure_id=i, customer_id=c, exposure_date=day, month_id=m) for i, (c, day, m) in enumerate(rows)],
        "exposure_id long, customer_id long, exposure_date date, month_id int",
    )


def _brute(tx_rows, anchors, pre, post):
    out = {}
    for (c, m), a in anchors.items():
        res = {}
        for side, lo, hi in (("pre", -pre, -1), ("post", 0, post - 1)):
            hits = [r for r in tx_rows if r[1] == c and lo <= (r[2] - a).days <= hi]
            res[side] = (
                len({r[0] for r in hits if r[0] is not None}),
                round(sum(r[3] for r in hits), 6),
                len({r[2] for r in hits}),
            )
        out[(c, m)] = res
    return out


def _spark_pp(spark, tx_rows, ex_rows, cfg):
    anc = windows.anchors(_ex(spark, ex_rows))
    pp = windows.pre_post(anc, _tx(spark, tx_rows), cfg).collect()
    return {
        (r.customer_id, r.month_id): {
            "pre": (r.pre_txn_cnt, round(r.pre_revenue, 6), r.pre_active_days),
            "post": (r.post_txn_cnt, round(r.post_revenue, 6), r.post_active_days),
        }
        for r in pp
    }, {(r.customer_id, r.month_id): r.anchor_exposure_date for r in pp}


def test_window_boundaries_s1(spark):
    """PRE is [a-28, a-1], POST is [a, a+6]; the anchor day is POST."""
    tx = [(i, 1, d(off), 10.0 * (i + 1)) for i, off in enumerate([-29, -28, -1, 0, 6, 7])]
    ex = [(1, d(0), 202503)]
    got, _ = _spark_pp(spark, tx, ex, LiftConfig())
    assert got[(1, 202503)]["pre"] == (2, 20.0 + 30.0, 2)
    assert got[(1, 202503)]["post"] == (2, 40.0 + 50.0, 2)


def test_anchor_is_first_contact_and_windows_overlap_s2_s4(spark):
    ex = [(1, d(5), 202503), (1, d(2), 202503), (1, d(22), 202504), (2, d(3), 202503)]
    tx = [(1, 1, d(21), 5.0), (2, 1, d(23), 7.0), (3, 2, d(-3), 1.0)]
    got, anchors = _spark_pp(spark, tx, ex, LiftConfig())
    assert anchors[(1, 202503)] == d(2)
    # The purchase on d(21) is POST of nothing for March (d(2)+6 = d(8)) but PRE of April.
    assert got[(1, 202504)]["pre"][0] == 1 and got[(1, 202504)]["post"][0] == 1
    assert got[(2, 202503)]["pre"] == (1, 1.0, 1)


def test_duplicate_ids_count_once_revenue_twice_s5(spark):
    """COUNT(DISTINCT id) but SUM(revenue): duplicates inflate revenue only,
    also when the same id sits on two days of one window."""
    tx = [
        (100, 1, d(-3), 10.0),
        (100, 1, d(-3), 10.0),  # exact copy, same day
        (200, 1, d(-5), 4.0),
        (200, 1, d(-2), 4.0),  # same id, two days, both PRE
        (300, 1, d(-30), 1.0),
        (300, 1, d(1), 2.0),  # id first seen before PRE, again in POST
        (None, 1, d(2), 8.0),  # no id: revenue and day count, no transaction
    ]
    ex = [(1, d(0), 202503)]
    got, _ = _spark_pp(spark, tx, ex, LiftConfig())
    assert got[(1, 202503)]["pre"] == (2, 28.0, 3)
    assert got[(1, 202503)]["post"] == (1, 10.0, 2)


def test_no_purchase_zero_fill_and_aov_s6_s9(spark):
    tx = [(1, 1, d(-3), 12.0)]
    ex = [(1, d(0), 202503), (2, d(0), 202503)]
    cust = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "customer_id long, is_active int, is_high_value int")
    anc = windows.anchors(_ex(spark, ex))
    f = {r.customer_id: r for r in lift.fact(windows.pre_post(anc, _tx(spark, tx)), cust).collect()}
    assert f[2].pre_revenue == 0.0 and f[2].post_txn_cnt == 0 and f[2].incremental_revenue == 0.0
    # No POST purchase: post AOV is 0.0, so delta AOV is minus the PRE AOV.
    assert f[1].pre_aov == 12.0 and f[1].post_aov == 0.0 and f[1].delta_aov == -12.0
    assert abs(f[1].incremental_revenue - (0.0 - 12.0 / 28) * 7) < 1e-12


def test_unknown_customer_dropped_s7(spark):
    tx = [(1, 9, d(-1), 3.0)]
    ex = [(9, d(0), 202503)]
    cust = spark.createDataFrame([(1, 1, 1)], "customer_id long, is_active int, is_high_value int")
    anc = windows.anchors(_ex(spark, ex))
    assert lift.fact(windows.pre_post(anc, _tx(spark, tx)), cust).count() == 0


def test_random_against_brute_force(spark):
    rnd = random.Random(7)
    tx = []
    for i in range(400):
        c = rnd.randint(1, 6)
        tid = rnd.choice([i, i, i, rnd.randint(0, 50)])  # some ids repeat across days
        tx.append((tid, c, d(rnd.randint(-70, 70)), round(rnd.uniform(1, 50), 2)))
    ex = [(rnd.randint(1, 6), d(rnd.randint(-40, 40)), rnd.choice([202502, 202503, 202504])) for _ in range(40)]
    for cfg in (LiftConfig(), LiftConfig(pre_days=14, post_days=3), LiftConfig(pre_days=56, post_days=14)):
        got, anchors = _spark_pp(spark, tx, ex, cfg)
        assert got == _brute(tx, anchors, cfg.pre_days, cfg.post_days)


def test_one_join_for_all_windows(spark):
    """The fused plan has one join between anchors and purchases."""
    tx = [(1, 1, d(-1), 3.0)]
    ex = [(1, d(0), 202503)]
    anc = windows.anchors(_ex(spark, ex))
    plan = windows.pre_post(anc, _tx(spark, tx))._jdf.queryExecution().executedPlan().toString()
    joins = plan.count("HashJoin") + plan.count("SortMergeJoin") + plan.count("NestedLoopJoin")
    assert joins == 1, plan
