"""Windows by running totals and periods by position, against plain definitions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from beforeafter import session
from beforeafter.operators import bias, running, sensitivity, windows
from tests.conftest import SF_SMALL

D0 = dt.date(2025, 3, 10)
WINDOWS = {"a": (-28, -1), "b": (0, 6), "c": (-14, -1), "d": (0, 0), "e": (-3, 9), "f": (2, 400)}


def day(k):
    return D0 + dt.timedelta(days=k)


def stream(spark, rows):
    tx = spark.createDataFrame(rows, "transaction_id long, customer_id long, transaction_date date, revenue double")
    return windows.purchase_days(tx)


def anchors(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, month_id int, anchor_exposure_date date")


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_paired_windows_and_to_brute_force(spark, seed):
    rng = random.Random(seed)
    tx = [
        (rng.choice([None, *range(6)]), rng.choice([1, 2, None]), rng.choice([None, *[day(k) for k in range(-35, 15)]]),
         rng.choice([None, -4.25, 0.1, 7.0]))
        for _ in range(220)
    ]
    asked = [(c, m, day(rng.randrange(-20, 20))) for c in (1, 2, 3, None) for m in range(4)] + [(1, 9, None)]
    days, anc = stream(spark, tx), anchors(spark, asked)
    got = running.window_totals(anc, days, WINDOWS)
    per = {(r.customer_id, r.month_id): r for r in got.collect()}
    assert len(per) == len(asked)
    for c, m, a in asked:
        for name, (lo, hi) in WINDOWS.items():
            hit = [t for t in tx if c is not None and a and t[1] == c and t[2] and lo <= (t[2] - a).days <= hi]
            r = per[c, m]
            assert r[f"{name}_txn_cnt"] == len({t[0] for t in hit if t[0] is not None}), (c, m, name)
            assert r[f"{name}_active_days"] == len({t[2] for t in hit})
            assert r[f"{name}_revenue"] == pytest.approx(sum(t[3] or 0 for t in hit), abs=1e-9)
    paired = windows.window_aggregates(anc, days, WINDOWS)
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if c.endswith("revenue") else c for c in df.columns])
    assert rows_of(rounded(got)) == rows_of(rounded(paired))


def test_no_purchases_no_anchors_and_large_totals(spark):
    some, nothing = [(1, 202503, day(0))], anchors(spark, [])
    empty = stream(spark, [])
    r = running.window_totals(anchors(spark, some), empty, {"w": (-7, -1)}).first()
    assert (r.w_txn_cnt, r.w_revenue, r.w_active_days) == (0, 0.0, 0)
    assert running.window_totals(nothing, empty, WINDOWS).count() == 0
    # what other days hold leaves no trace in a window's revenue
    big = stream(spark, [(1, 1, day(-90), 1e15), (2, 1, day(-1), 0.01)])
    assert running.window_totals(anchors(spark, some), big, {"w": (-7, -1)}).first().w_revenue == 0.01
    with pytest.raises(ValueError):
        running.window_totals(nothing, empty, {"w": (1, 0)})


def test_no_pairing_and_one_shuffle_of_each_side(spark, tmp_path):
    stream(spark, [(1, 1, day(0), 1.0)]).write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    plan = running.window_totals(anchors(spark, [(1, 1, day(0))]), days, WINDOWS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    # customers' rows meet once; the totals per anchor are built where they are
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Anchors and days make more tasks, not larger ones, and the same totals; what is
    moved is one row per anchor and day, not one per lookup."""
    rng = random.Random(5)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 4)
    days = stream(spark, [(i, i % 40, day(rng.randrange(90)), float(i)) for i in range(120)])
    anc = anchors(spark, [(c, m, day(rng.randrange(90))) for c in range(45) for m in (202503, 202504)])
    ids = spark.createDataFrame([(c,) for c in range(43)], "customer_id long")
    got = sensitivity.totals(anc, days, ids)
    known = anc.join(ids, "customer_id", "left_semi")
    wins = {f"pre{p}": (-p, -1) for p in (14, 28, 56)} | {f"post{q}": (0, q - 1) for q in (3, 7, 14)}
    assert rows_of(got) == rows_of(windows.window_aggregates(known, days, wins).select(*got.columns))
    text = got._jdf.queryExecution().executedPlan().toString()
    tasks = -(-(anc.count() + days.count()) // 4)
    # a plan is printed from its result down: the rows multiply after the shuffle
    assert text.index("Generate explode(") < text.index(f", {tasks}), REPARTITION_BY_NUM")


def test_segments_are_looked_up_before_the_pairs(spark):
    """The stored frame of the sensitivity per segment has one row per anchor; the nine
    pairs of an anchor are made after the segment is joined."""
    plan = E.queries()["sensitivity_by_segment"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "pre56_revenue" in plan and plan.index("Generate explode") < plan.index("Join")


def test_gate_reads_a_stored_fact_without_flags(spark):
    plan = E.queries()["final_gate"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "/lifts-" in plan and "/anchors-" in plan and "c_acctbal" not in plan


def test_periods_found_by_position(spark):
    rng = random.Random(3)
    spans = [(s, s + rng.randrange(0, 9)) for s in rng.sample(range(0, 700), 40)] + [(5, 3), (50, 50), (50, 50)]
    periods = spark.createDataFrame([(day(s), day(e)) for s, e in spans] + [(None, day(1)), (day(1), None)],
                                    "period_start date, period_end date")
    merged = sorted((r.period_start, r.period_end) for r in bias.disjoint(periods).collect())
    covered = {day(k) for s, e in spans for k in range(s, e + 1)}
    assert {a + dt.timedelta(days=k) for a, b in merged for k in range((b - a).days + 1)} == covered
    assert all(b + dt.timedelta(days=1) < a for (_, b), (a, _) in zip(merged, merged[1:]))
    fact = spark.createDataFrame([(k, day(k)) for k in range(-60, 800)] + [(None, None)], "k int, anchor_exposure_date date")
    for pre, post in ((28, 7), (0, 1), (2, 3)):
        flags = {r.k: r.period_flag for r in bias.annotate_periods(fact, periods, pre, post).collect()}
        for k in range(-60, 800):
            touched = any(k - pre <= e and k + post - 1 >= s for s, e in spans if s <= e)
            assert flags[k] == ("promo" if touched else "quiet"), (k, pre, post)
        assert flags[None] == "quiet"
        assert bias.exclude_periods(fact, periods.limit(0), pre, post).count() == 861
