"""Registered queries: contract, oracle agreement and plan shape."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from beforeafter.plans import registry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

registry.load_all()


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd

        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item") and not hasattr(v, "isoformat"):
        v = v.item()
    if hasattr(v, "isoformat"):
        if hasattr(v, "hour") and (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(df, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")),
                  key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def test_contract():
    qs, sq = E.queries(), E.oracle_sql()
    assert len(qs) >= 97
    assert set(sq) <= set(qs)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["month_id", "exposed_customer_months", "incremental_revenue",
                          "incremental_transactions", "avg_delta_aov"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


# Every query of the core registry; those of the optional subpackage have tests of their own.
NAMES = sorted(registry.ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dp = duck.sql(E.oracle_sql()[name]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dp.columns)
    assert len(sp) == len(dp)
    assert _rows(sp, cols) == _rows(dp, cols)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_and_rfm_plans_have_no_range_nested_loop(spark):
    """Range joins are bucketed or exploded to equi-joins; the only nested
    loops left are cross joins with one-row threshold frames."""
    qs = E.queries()
    for name in ("lift_fact", "rfm_segments", "sensitivity_grid", "post_decay"):
        plan = _plan(qs[name](spark, SF_SMALL))
        for line in plan.splitlines():
            if "BroadcastNestedLoopJoin" in line:
                assert "Cross" in line, (name, line)
                assert "day" not in line and "transaction_date" not in line and "month_end" not in line, (name, line)


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(E.queries()["lift_fact"](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans
    for ln in scans:
        if "l_returnflag" in ln:
            assert "EqualTo(l_returnflag,R)" in ln
        # No scan reads every column of lineitem.
        assert "l_comment" not in ln and "l_extendedprice" not in ln


def _scans(df, column):
    return [ln for ln in _plan(df).splitlines() if "FileScan parquet" in ln and column in ln]


def test_calendar_comes_from_the_bare_date_columns(spark):
    plan = _plan(E.queries()["month_ends"](spark, SF_SMALL))
    assert "Join" not in plan


def test_stored_tables_are_read_instead_of_the_sources(spark):
    """Views and checks over the gold tables do not reach the sources again."""
    for name in ("segment_shares", "check_reconcile", "narrative_rfm", "coverage", "rate_box", "lift_histogram"):
        df = E.queries()[name](spark, SF_SMALL)
        assert not _scans(df, "l_orderkey") and not _scans(df, "o_orderkey"), name
    assert len(_scans(E.queries()["promo_vs_quiet"](spark, SF_SMALL), "l_orderkey")) <= 2


def test_flags_that_nobody_reads_are_not_computed(spark):
    """Only the ids of customers are scanned, once, and orders without their prices' quantiles."""
    for name in ("summary_month", "zero_shares", "check_no_activity"):
        scans = _scans(E.queries()[name](spark, SF_SMALL), "c_custkey")
        assert len(scans) == 1 and "c_acctbal" not in scans[0], name


def test_ranking_runs_no_job_while_its_plan_is_built(spark):
    from pyspark.sql import functions as F

    from beforeafter.operators import ranking

    sc = spark.sparkContext
    sc.setJobGroup("ranking-plan", "")
    ranking.ntiles(spark.range(50).withColumn("g", F.lit(1)), "g", {"t": F.col("id") % 7}, F.col("id"), 5)
    assert not sc.statusTracker().getJobIdsForGroup("ranking-plan")
    sc.setLocalProperty("spark.jobGroup.id", None)
