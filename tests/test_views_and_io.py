"""Views on hand-made summaries, and sources/sinks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from beforeafter.plans import narrative as N
from beforeafter.plans import views as V
from beforeafter.sources import files, schemas


def _rfm(spark, rows):
    return spark.createDataFrame(
        rows, "month_id int, rfm_segment string, customers long, incremental_revenue double, "
        "incremental_transactions double, avg_delta_aov double"
    )


def test_shares_and_offsets_s25_s29(spark):
    rows = [
        (202501, "A", 1, 10.0, 1.0, 1.0), (202501, "B", 1, -4.0, 1.0, 1.0), (202501, "C", 1, -8.0, 1.0, 1.0),
        (202502, "A", 1, 10.0, 1.0, 1.0), (202502, None, 1, -2.0, 1.0, 1.0),
    ]
    sh = {r.month_id_norm: r for r in V.shares(_rfm(spark, rows), 4).collect()}
    jan, feb = sh["202501"], sh["202502"]
    assert jan.total_rev_net == -2.0 and jan.share_of_net == -5.0 and jan.net_negative_share
    assert jan.share_of_positive == 1.0 and not jan.top_exceeds_net
    assert feb.share_of_net == 1.25 and feb.top_exceeds_net
    tb = {r.month_id_norm: r for r in V.top_bottom(_rfm(spark, rows), 4).collect()}
    assert tb["202502"].bottom_segment == "Unknown"
    text = {r.month_id_norm: r for r in N.flat(N.rfm(V.top_bottom(_rfm(spark, rows), 4).join(
        V.contribution(_rfm(spark, rows), 4), "month_id_norm"))).collect()}
    # Net is negative in January: the text falls back to the share of positive contributions.
    assert "100.0% of positive contributions" in text["202501"].headline
    assert "125.0% of net" in text["202502"].headline


def test_mean_of_means_s20(spark):
    by_month = spark.createDataFrame(
        [(202501, 10, 1.0, 1.0, 2.0), (202502, 1000, 1.0, 1.0, 4.0)],
        "month_id int, exposed_customer_months long, incremental_revenue double, incremental_transactions double, "
        "avg_delta_aov double",
    )
    h = V.headline(by_month, 4).first()
    assert h.mean_of_means_delta_aov == 3.0 and h.total_inc_rev == 2.0


def test_unmapped_flags_dropped_s23(spark):
    flags = spark.createDataFrame(
        [(202501, 1, 1, 5, 3.0, 1.0, 1.0), (202501, 0, None, 5, 4.0, 1.0, 1.0)],
        "month_id int, is_active int, is_high_value int, customers long, incremental_revenue double, "
        "incremental_transactions double, avg_delta_aov double",
    )
    g = V.by_value_group(flags, 4).collect()
    assert [(r.value_group, r.incremental_revenue) for r in g] == [("High Value", 3.0)]


def test_latest_month_is_a_join_not_a_collect(spark):
    df = V.month_fields(_rfm(spark, [(202412, "A", 1, 1.0, 1.0, 1.0), (202501, "A", 1, 2.0, 1.0, 1.0),
                                     (None, "A", 1, 9.0, 1.0, 1.0)]))
    assert [r.month_id for r in V.for_month(df).collect()] == [202501]
    assert V.latest_month(df).first().latest_month == "202501"


def test_strict_csv_fails_on_bad_row(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("month_id,exposed_customer_months,incremental_revenue,incremental_transactions,avg_delta_aov\n"
                 "202501,3,1.5,0.25,2.0\n202502,x,1.0,1.0,1.0\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|NumberFormat|parse"):
        files.read_csv_strict(spark, str(p), schemas.AGG_MONTH).collect()


def test_single_csv_export_and_optional_read(spark, tmp_path):
    df = spark.createDataFrame([(202501, 3, 1.5, 0.25, 2.0), (202502, 4, -1.0, 1.0, -3.0)], schemas.AGG_MONTH)
    out = files.export_single_csv(df.repartition(4), str(tmp_path / "exp"), "agg.csv")
    visible = sorted(f for f in os.listdir(tmp_path / "exp") if not f.startswith("."))  # local FS keeps .crc files
    assert os.path.isfile(out.replace("file:", "")) and visible == ["agg.csv"]
    back = files.read_gold(spark, out, schemas.AGG_MONTH)
    assert sorted(back.collect()) == sorted(df.collect())
    empty = files.read_gold(spark, str(tmp_path / "missing.csv"), schemas.AGG_MONTH, required=False)
    assert empty.count() == 0 and empty.schema == schemas.AGG_MONTH
    with pytest.raises(FileNotFoundError):
        files.read_gold(spark, str(tmp_path / "missing.csv"), schemas.AGG_MONTH, required=True)


def test_load_table_over_stale_folder(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    files.load_table(df, "t_stale", recreate=True)
    spark.catalog.dropTempView("t_stale")
    loc = files._managed_location(spark, "t_stale")
    spark.sql("DROP TABLE IF EXISTS t_stale")
    # Recreate a stray folder at the managed location, as a lost catalog would leave it.
    df.write.mode("overwrite").parquet(loc)
    out = files.load_table(spark.createDataFrame([(3, 4, 5)], "a int, b int, c int"), "t_stale")
    assert out.collect()[0].c == 5


def test_display_views(spark):
    df = spark.createDataFrame([(1,)], "x int")
    names = files.register_views({"agg_incrementality_month": df})
    assert names == ["Agg Incrementality Month"]
    assert spark.sql("SELECT x FROM `Agg Incrementality Month`").first().x == 1
    assert F is not None
