"""The batch pipeline end to end on sf 0.001, checked with the invariants the
method's published summaries satisfy."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from beforeafter.plans import pipeline
from beforeafter.sources import files, schemas
from beforeafter.sources.bindings import binding_a
from tests.conftest import SF_SMALL


def test_build_gold_invariants(spark, tmp_path):
    b = binding_a(spark, SF_SMALL)
    paths = pipeline.build_gold(b.customers, b.dates, b.transactions, b.exposures, str(tmp_path / "gold"))
    fact = spark.read.parquet(paths[pipeline.FACT])
    month = files.read_csv_strict(spark, paths[pipeline.MONTH], schemas.AGG_MONTH)
    by_rfm = files.read_csv_strict(spark, paths[pipeline.BY_RFM], schemas.AGG_RFM)
    flags = files.read_csv_strict(spark, paths[pipeline.BY_FLAGS], schemas.AGG_ACTIVE_VALUE)

    # One row per customer and month; fact partitioned by month on storage.
    assert fact.count() == fact.select("customer_id", "month_id").distinct().count()
    assert "month_id=" in " ".join(str(p) for p in (tmp_path / "gold" / pipeline.FACT).iterdir())

    m = {r.month_id: r for r in month.collect()}

    def roll(df, cust):
        return {
            r.month_id: r
            for r in df.groupBy("month_id").agg(
                F.sum(cust).alias("c"),
                F.sum("incremental_revenue").alias("rev"),
                F.sum("incremental_transactions").alias("txn"),
                F.sum(F.col("avg_delta_aov") * F.col(cust)).alias("w"),
            ).collect()
        }

    for df in (by_rfm, flags):
        rolled = roll(df, "customers")
        assert set(rolled) == set(m)
        for k, r in rolled.items():
            assert r.c == m[k].exposed_customer_months
            assert abs(r.rev - m[k].incremental_revenue) < 1e-6
            assert abs(r.txn - m[k].incremental_transactions) < 1e-9
            # Customer-weighted mean of the group means equals the month mean.
            assert abs(r.w / r.c - m[k].avg_delta_aov) < 1e-6

    # PRE 28 / POST 7 on cent prices: lift in transactions on a 0.25 grid,
    # in revenue on a 0.0025 grid.
    grid = fact.select(
        (F.abs(F.col("incremental_transactions") * 4 - F.round(F.col("incremental_transactions") * 4)) < 1e-9).alias("t"),
        (F.abs(F.col("incremental_revenue") * 400 - F.round(F.col("incremental_revenue") * 400)) < 1e-5).alias("r"),
    )
    assert grid.where(~F.col("t") | ~F.col("r")).count() == 0
    # At most four flag groups per month.
    assert flags.groupBy("month_id").count().where(F.col("count") > 4).count() == 0


def _tables(spark, folder):
    csv = {pipeline.MONTH: schemas.AGG_MONTH, pipeline.BY_RFM: schemas.AGG_RFM, pipeline.BY_FLAGS: schemas.AGG_ACTIVE_VALUE}
    out = {}
    for name in (pipeline.FACT, pipeline.RFM, *csv):
        df = (
            files.read_csv_strict(spark, f"{folder}/{name}.csv", csv[name])
            if name in csv
            else spark.read.parquet(f"{folder}/{name}")
        )
        out[name] = sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    return out


def _files(spark, folder, months):
    rows = pipeline.manifest(spark, folder).where(~F.col("month_id").isin(months)).collect()
    return sorted((r.table_name, r.month_id, r.file_path, r.written_at, r.row_count) for r in rows)


def test_rebuilt_months_equal_a_full_build(spark, tmp_path):
    b = binding_a(spark, SF_SMALL)
    months = sorted(r[0] for r in b.exposures.select("month_id").distinct().collect())
    early, late, gone = months[len(months) // 2], months[-1], months[3]
    full = b.exposures.where(F.col("month_id") != gone)  # the last state: one month has no contacts any more
    known = b.exposures.where(~F.col("month_id").isin(early, late))
    args = (b.customers, b.dates, b.transactions)
    whole, place = str(tmp_path / "whole"), str(tmp_path / "gold")
    pipeline.build_gold(*args, full, whole)
    pipeline.build_gold(*args, known, place)
    changed = [early, late, gone]
    before = _files(spark, place, changed)
    pipeline.rebuild_months(*args, full, place, changed)
    assert _files(spark, place, changed) == before
    assert _tables(spark, place) == _tables(spark, whole)
    pipeline.rebuild_months(*args, full, place, [])
    assert _files(spark, place, changed) == before
    with pytest.raises(ValueError):
        pipeline.rebuild_months(*args, full, place, [7])
