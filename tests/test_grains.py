"""One pass over the fact against each summary and measure computed on its own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from beforeafter import session
from beforeafter.operators import grains, measures, summary
from beforeafter.session import materialize
from tests.conftest import SF_SMALL

FACT = (
    "customer_id int, month_id int, month_key_yyyymm int, is_active int, is_high_value int, incremental_revenue double, "
    "incremental_transactions double, delta_aov double, pre_rev_per_day double, post_rev_per_day double, extra string"
)
ROWS = [
    (1, 202501, 202501, 1, 0, 2.5, 1.0, 0.5, 1.0, 2.0, "x"),
    (1, 20250115, 202501, 1, 0, -1.25, 0.0, None, 0.0, 0.0, None),  # the same month under its other key
    (1, 202502, 202502, 1, 0, 4.0, 2.0, 1.0, 3.0, 1.0, "x"),
    (2, 202501, 202501, None, 1, 0.1, 0.2, 0.3, 0.4, 0.5, "x"),
    (2, None, None, None, 1, 0.2, 0.1, 0.7, 0.1, 0.1, "x"),
    (3, 202502, 202502, 0, None, None, None, None, None, None, "x"),
    (3, 202502, 202502, 0, None, 1.0, 1.0, 1.0, 1.0, 1.0, "x"),
    (None, 202502, 202502, 0, 0, 9.0, 1.0, 1.0, 1.0, 1.0, "x"),
]
RFM = [(1, 202501, "Lost"), (1, 202502, "Champions"), (3, 202502, "Lost"), (None, 202502, "Others"), (4, 202501, "Lost")]


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(ROWS, FACT),
        spark.createDataFrame(RFM, "customer_id int, month_id int, rfm_segment string"),
    )


def rows(df):
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()),
        key=key,
    )


@pytest.mark.parametrize("exact", [True, False])
def test_every_grain_equals_its_own_aggregate(tables, exact):
    fact, rfm = tables
    rolled = grains.rollup(fact, rfm, exact).cache()
    assert rows(grains.by_month(rolled)) == rows(summary.by_month(fact, exact))
    assert rows(grains.by_rfm(rolled)) == rows(summary.by_rfm(fact, rfm, exact))
    assert rows(grains.by_flags(rolled)) == rows(summary.by_flags(fact, exact))
    named = fact.drop("month_id").withColumnRenamed("month_key_yyyymm", "month_id")
    for grain in ("total", "month", "flags", "month_flags"):
        own = measures.evaluate(named, measures.NAMES, by=grains.GRAINS[grain], exact=exact)
        assert rows(grains.measures_at(rolled, grain)) == rows(own), grain
    joined = measures.with_segment(fact, rfm)
    own = measures.evaluate(joined, measures.NAMES, by=["rfm_segment"], exact=exact)
    seg = grains.measures_at(rolled, "segment").withColumn("rfm_segment", F.coalesce("rfm_segment", F.lit("Unknown")))
    assert rows(seg) == rows(own)
    total = rolled.where("grain = 'total'").first()
    assert (total.row_count, total.customers) == (8, 3)
    rolled.unpersist()


def test_empty_fact_gives_no_rows(tables):
    fact, rfm = tables
    assert grains.rollup(fact.where("false"), rfm).count() == 0
    without = grains.rollup(fact, rfm.where("false"), True)
    assert without.where("grain = 'segment'").select("rfm_segment", "row_count").collect() == [(None, 8)]


def test_one_scan_and_no_distinct_aggregate(spark, tables):
    fact, rfm = tables
    rolled = grains.rollup(materialize(fact, "grains-fact"), materialize(rfm, "grains-rfm"), True)
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert len(scans) == 2 and all("extra" not in ln for ln in scans)
    assert "Expand" not in plan and "distinct" not in plan
    # the join's own, one to the customer, one for the finished groups
    assert sum("Exchange hashpartitioning" in ln and "customer_id" in ln and "grain" not in ln for ln in plan.splitlines()) <= 3
    assert sum("Exchange hashpartitioning(grain" in ln for ln in plan.splitlines()) == 1


def test_tasks_follow_the_rows_of_the_fact(spark, tables, monkeypatch):
    fact, rfm = tables
    one = rows(grains.rollup(fact, rfm, True))
    monkeypatch.setattr(session, "ROWS_PER_TASK", 1)
    many = fact.unionByName(fact.withColumn("customer_id", F.col("customer_id") + 10)).unionByName(
        fact.withColumn("customer_id", F.col("customer_id") + 20)
    )
    plan = grains.rollup(many, rfm, True)._jdf.queryExecution().executedPlan().toString()
    tasks = max(many.count(), spark.sparkContext.defaultParallelism)
    assert f", {tasks}), REPARTITION_BY_NUM" in plan
    assert rows(grains.rollup(fact, rfm, True)) == one


def test_small_frames_keep_the_usual_partitions(spark, tables):
    plan = session.spread(tables[0], 8, "customer_id")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_reconciliation_reads_the_fact_once(spark):
    """The three summaries that are compared come from one stored frame of groups."""
    plan = E.queries()["check_reconcile"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert len(scans) == 3 and all("grain" in ln and "rollup-" in ln for ln in scans)
