"""The batch pipeline: sources -> silver -> gold tables on storage.

Layering as the method does it, with each shared intermediate computed once:

1. the customer-day purchase stream (silver) is written once and read by the
   PRE/POST windows and by RFM;
2. the customer-month fact and the RFM dimension (gold, unbounded size) are
   written as parquet partitioned by month;
3. the three summaries are computed in one pass over the written gold tables
   and exported as single CSV files (they are one row per month and group).

``rebuild_months`` brings single months up to date after late rows: it reads the
purchases and contacts those months can depend on, replaces their folders and
their rows of the summaries, and leaves every other file as it is.

Everything lands under ``out_dir``; intermediates go to the shared checkpoint
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.config import DEFAULT, LiftConfig
from beforeafter.functions.months import month_key
from beforeafter.operators import grains, lift, rfm, windows
from beforeafter.session import materialize
from beforeafter.sources import files, schemas

FACT = "fact_customer_month_incrementality"
RFM = "dim_customer_month_rfm"
MONTH = "agg_incrementality_month"
BY_RFM = "agg_incrementality_rfm"
BY_FLAGS = "agg_incrementality_active_value"


def build_gold(
    customers: DataFrame,
    dates: DataFrame,
    transactions: DataFrame,
    exposures: DataFrame,
    out_dir: str,
    cfg: LiftConfig = DEFAULT,
    exact: bool = True,
) -> dict[str, str]:
    """Write the five gold tables; returns name -> path."""
    spark = transactions.sparkSession
    days = materialize(windows.purchase_days(transactions), "purchase-days")
    pp = windows.pre_post(windows.anchors(exposures), transactions, cfg, days=days)
    fact = lift.fact(pp, customers, cfg)
    seg = rfm.segments(transactions, dates, cfg, stream=days)
    base = out_dir.rstrip("/")
    paths = files.export_gold({FACT: fact, RFM: seg}, base)
    fact_t = spark.read.parquet(paths[FACT])
    rfm_t = spark.read.parquet(paths[RFM])
    rolled = materialize(grains.rollup(fact_t, rfm_t, exact), "rollup")
    paths.update(
        files.export_gold(
            {MONTH: grains.by_month(rolled), BY_RFM: grains.by_rfm(rolled), BY_FLAGS: grains.by_flags(rolled)}, base
        )
    )
    return paths


def rebuild_months(
    customers: DataFrame,
    dates: DataFrame,
    transactions: DataFrame,
    exposures: DataFrame,
    out_dir: str,
    months: list[int],
    cfg: LiftConfig = DEFAULT,
    exact: bool = True,
) -> dict[str, str]:
    """Rebuild the stored months ``months`` (values of ``month_id``) of a folder that
    ``build_gold`` wrote; returns name -> path.

    Read are the contacts of those months, and the purchases from the earliest PRE
    or RFM window to the latest POST window or month end.  The months' folders of
    the fact and the RFM dimension are replaced by dynamic partition overwrite, a
    month that has no rows any more loses its folder, and their rows in the
    summaries are replaced; other months' files stay untouched.  The result equals
    a full build if only those months changed: customer flags come from
    ``customers`` as given, so a change of the flags needs a full build.  A month
    whose key does not parse is an error, no months is no change.
    """
    spark = transactions.sparkSession
    base = out_dir.rstrip("/")
    paths = {n: f"{base}/{n}" for n in (FACT, RFM)} | {n: f"{base}/{n}.csv" for n in (MONTH, BY_RFM, BY_FLAGS)}
    if not months:
        return paths
    listed = spark.createDataFrame([(m,) for m in sorted(set(months))], "month_id int")
    keys = sorted({r[0] or 0 for r in listed.select(month_key(F.col("month_id"))).collect()})
    if keys[0] == 0:
        raise ValueError(f"not all of {months} are month keys")
    here = F.col("month_id").isin(months)
    contacts, calendar = exposures.where(here), dates.where(here)

    a = contacts.agg(F.min("exposure_date").alias("lo"), F.max("exposure_date").alias("hi")).select(
        F.date_sub("lo", cfg.pre_days).alias("lo"), F.date_add("hi", cfg.post_days - 1).alias("hi")
    )
    e = rfm.month_ends(calendar).agg(F.min("month_end").alias("lo"), F.max("month_end").alias("hi")).select(
        F.date_sub("lo", cfg.rfm_days - 1).alias("lo"), "hi"
    )
    span = a.unionByName(e).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()  # one row
    bought = transactions.where(F.col("transaction_date").between(F.lit(span.lo), F.lit(span.hi)))

    days = materialize(windows.purchase_days(bought), "purchase-days")
    pp = windows.pre_post(windows.anchors(contacts), bought, cfg, days=days)
    fresh = {
        FACT: materialize(lift.fact(pp, customers, cfg), "months-of-fact"),
        RFM: materialize(rfm.segments(bought, calendar, cfg, stream=days), "months-of-rfm"),
    }
    for name, df in fresh.items():
        files.replace_partitions(df, paths[name], "month_id", months)
    same_key = month_key(F.col("month_id")).isin(keys)  # a month may be stored under two keys
    stored = {n: spark.read.schema(df.schema).parquet(paths[n]).where(same_key) for n, df in fresh.items()}
    rolled = materialize(grains.rollup(stored[FACT], stored[RFM], exact), "rollup")
    others = ~F.coalesce(F.col("month_id").isin(keys), F.lit(False))
    new = {
        MONTH: (grains.by_month(rolled), schemas.AGG_MONTH),
        BY_RFM: (grains.by_rfm(rolled), schemas.AGG_RFM),
        BY_FLAGS: (grains.by_flags(rolled), schemas.AGG_ACTIVE_VALUE),
    }
    for name, (rows, schema) in new.items():
        old = files.read_csv_strict(spark, paths[name], schema).where(others)
        files.export_single_csv(old.unionByName(rows), base, f"{name}.csv")
    return paths


def manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """What lies in a gold folder: table_name, month_id, file_path, written_at and
    row_count of every file of the fact and the RFM dimension."""
    parts = [
        spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
        .select(
            F.lit(name).alias("table_name"),
            "month_id",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("written_at"),
        )
        .groupBy("table_name", "month_id", "file_path", "written_at")
        .agg(F.count(F.lit(1)).alias("row_count"))
        for name in (FACT, RFM)
    ]
    return parts[0].unionByName(parts[1])
