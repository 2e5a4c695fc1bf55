"""Queries for sources and sinks (A) and conforming (B)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.functions.numeric import rsum
from beforeafter.operators import lift, silver, summary, windows
from beforeafter.plans import pipeline
from beforeafter.plans import sql as S
from beforeafter.plans.present import round_cols
from beforeafter.plans.queries_core import SUMMARY_MONTH_SQL, chain
from beforeafter.plans.registry import register
from beforeafter.session import materialize
from beforeafter.sources import files, schemas
from beforeafter.sources.bindings import binding_a

TS_FMT = "yyyy-MM-dd HH:mm:ss"
SQL_TS_FMT = "%Y-%m-%d %H:%M:%S"


# ---------------------------------------------------------------- A


@register(
    "csv_roundtrip",
    S.with_(S.gold_a()) + "SELECT *, 'agg_incrementality_active_value.csv' AS file_name FROM agg_flags",
)
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A6: the flag summary exported as one CSV file and read back strictly;
    every row names the file it came from."""
    agg = summary.by_flags(chain(spark, sf_dir).fact, exact=True)
    path = files.export_single_csv(agg, files.scratch_dir(spark, "export"), "agg_incrementality_active_value.csv")
    back = files.read_csv_strict(spark, path, schemas.AGG_ACTIVE_VALUE)
    return back.withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


@register(
    "normalize_dates",
    S.with_(S.BINDING_A)
    + f"""SELECT exposure_id, CAST(exposure_date AS DATE) AS exposure_date,
  strftime(CAST(exposure_ts AS TIMESTAMP), '{SQL_TS_FMT}') AS exposure_ts FROM fact_crm_exposure""",
)
def q_normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: date and timestamp columns arriving as text are parsed back."""
    ex = binding_a(spark, sf_dir).exposures
    as_text = ex.select(
        "exposure_id",
        F.col("exposure_date").cast("string").alias("exposure_date"),
        F.date_format("exposure_ts", TS_FMT).alias("exposure_ts"),
    )
    out = files.normalize_dates(as_text, ("exposure_date",), ("exposure_ts",))
    return out.select("exposure_id", "exposure_date", F.date_format("exposure_ts", TS_FMT).alias("exposure_ts"))


@register("load_table", S.with_(S.BINDING_A) + "SELECT customer_id, is_active FROM dim_customer WHERE is_active = 1")
def q_load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: a table is loaded, then loaded again with other rows and columns; the
    second load is what remains."""
    cust = silver.customer(binding_a(spark, sf_dir).customers)
    name = f"ba_customer_load_{uuid.uuid4().hex}"
    files.load_table(cust, name)
    return files.load_table(cust.where("is_active = 1").select("customer_id", "is_active"), name, recreate=True)


@register(
    "table_row_counts",
    S.with_(S.BINDING_A, S.DATES)
    + """SELECT 'ba_dim_customer' AS table_name, COUNT(*) AS row_count FROM dim_customer
UNION ALL SELECT 'ba_dim_date', COUNT(*) FROM dim_date
UNION ALL SELECT 'ba_fact_transaction', COUNT(*) FROM fact_transaction
UNION ALL SELECT 'ba_fact_crm_exposure', COUNT(*) FROM fact_crm_exposure""",
)
def q_table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A5: the four silver tables loaded, then counted."""
    b = binding_a(spark, sf_dir)
    tx = b.transactions.withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp"))
    ex = b.exposures.withColumn("exposure_ts", F.col("exposure_ts").cast("timestamp"))
    loads = {
        "ba_dim_customer": silver.customer(b.customers),
        "ba_dim_date": silver.date(b.dates),
        "ba_fact_transaction": silver.transaction(tx),
        "ba_fact_crm_exposure": silver.exposure(ex),
    }
    run = f"_{uuid.uuid4().hex}"
    for name, df in loads.items():
        files.load_table(df, name + run)
    counts = files.row_counts(spark, [name + run for name in loads])
    return counts.withColumn("table_name", F.replace("table_name", F.lit(run), F.lit("")))


@register(
    "optional_source_empty",
    S.with_(S.chain_a())
    + f"""SELECT 'present' AS source, COUNT(*) AS row_count, 5 AS column_count FROM ({SUMMARY_MONTH_SQL})
UNION ALL SELECT 'missing', 0, 5""",
)
def q_optional_source_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required file that is there, and an optional one that is not: no rows,
    all columns."""
    agg = summary.by_month(chain(spark, sf_dir, flags=False).fact, exact=True)
    folder = files.scratch_dir(spark, "gold")
    path = files.export_single_csv(agg, folder, "agg_incrementality_month.csv")
    found = {
        "present": files.read_gold(spark, path, schemas.AGG_MONTH, required=True),
        "missing": files.read_gold(spark, f"{folder}/not_exported.csv", schemas.AGG_MONTH, required=False),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in found.items()
    ]
    return parts[0].unionByName(parts[1])


EXPORTED = {
    "agg_incrementality_active_value": ("agg_flags", "customers"),
    "agg_incrementality_month": ("agg_month", "exposed_customer_months"),
    "agg_incrementality_rfm": ("agg_rfm", "customers"),
    "fact_customer_month_incrementality": ("fact", "pre_txn_cnt"),
}


def _export_sql() -> str:
    lift = [
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(SUM({number}) AS BIGINT) AS total, "
        f"{S.xsum('incremental_revenue')} AS incremental_revenue, {S.xsum('incremental_transactions')} AS incremental_transactions FROM {t}"
        for name, (t, number) in EXPORTED.items()
    ]
    scores = (
        "SELECT 'dim_customer_month_rfm', COUNT(*), CAST(SUM(100 * r_score + 10 * f_score + m_score) AS BIGINT), NULL, NULL FROM rfm"
    )
    return S.with_(S.gold_a()) + "\nUNION ALL ".join([*lift, scores])


@register("export_gold", _export_sql())
def q_export_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch pipeline writes the five gold tables (customer grain as
    month-partitioned parquet, summaries as single CSV files); they are read back
    and their rows and values added up."""
    b = binding_a(spark, sf_dir)
    out = pipeline.build_gold(b.customers, b.dates, b.transactions, b.exposures, files.scratch_dir(spark, "gold"))
    return _added_up(spark, out)


@register("rebuild_month", _export_sql())
def q_rebuild_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tables built while the contacts of the last month are still
    missing, then that month rebuilt from all contacts; read back and added up like
    a full export.  A file of another month that changed fails the query."""
    b = binding_a(spark, sf_dir)
    last = b.exposures.agg(F.max("month_id")).first()[0]
    place = files.scratch_dir(spark, "gold")
    early = b.exposures.where(~F.col("month_id").eqNullSafe(F.lit(last)))
    pipeline.build_gold(b.customers, b.dates, b.transactions, early, place)
    before = materialize(pipeline.manifest(spark, place), "manifest")
    months = [last] if last is not None else []
    out = pipeline.rebuild_months(b.customers, b.dates, b.transactions, b.exposures, place, months)
    others = [m.where(~F.col("month_id").eqNullSafe(F.lit(last))) for m in (before, pipeline.manifest(spark, place))]
    if not others[0].exceptAll(others[1]).isEmpty():
        raise RuntimeError("a rebuild of one month changed files of another")
    return _added_up(spark, out)


def _added_up(spark: SparkSession, out: dict[str, str]) -> DataFrame:
    """Rows and added values of each exported gold table."""
    csv = {
        pipeline.MONTH: schemas.AGG_MONTH,
        pipeline.BY_RFM: schemas.AGG_RFM,
        pipeline.BY_FLAGS: schemas.AGG_ACTIVE_VALUE,
    }
    parts = []
    for name, path in sorted(out.items()):
        df = files.read_csv_strict(spark, path, csv[name]) if name in csv else spark.read.parquet(path)
        if name == pipeline.RFM:
            total = F.sum(F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score"))
            sums = [F.lit(None).cast("double"), F.lit(None).cast("double")]
        else:
            total = F.sum(EXPORTED[name][1])
            sums = [rsum("incremental_revenue", exact=True), rsum("incremental_transactions", exact=True)]
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                total.cast("long").alias("total"),
                sums[0].alias("incremental_revenue"),
                sums[1].alias("incremental_transactions"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


@register("ingest_sources", S.with_(S.chain_a()) + SUMMARY_MONTH_SQL + " HAVING COUNT(*) > 0")
def q_ingest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four sources as CSV, read strictly, normalised, loaded as
    tables, conformed, and taken to the month summary."""
    b = binding_a(spark, sf_dir)
    # extracts carry timestamps to the second and the responder column of the source
    exposures = b.exposures.withColumn("is_responder", F.lit(0))
    sources = {
        "dim_customer": b.customers,
        "dim_date": b.dates,
        "fact_transaction": b.transactions.withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp")),
        "fact_crm_exposure": exposures.withColumn("exposure_ts", F.col("exposure_ts").cast("timestamp")),
    }
    folder = files.scratch_dir(spark, "bronze")
    paths = {}
    for name, df in sources.items():
        paths[name] = f"{folder}/{name}"
        df.select(*schemas.SCHEMAS[name].fieldNames()).write.option("header", "true").csv(paths[name])
    bronze = files.ingest(spark, paths, suffix=f"_{uuid.uuid4().hex}")
    pp = windows.pre_post(
        windows.anchors(silver.exposure(bronze["fact_crm_exposure"])), silver.transaction(bronze["fact_transaction"])
    )
    return summary.by_month(lift.fact(pp, silver.customer(bronze["dim_customer"])), exact=True)


@register(
    "display_views",
    S.with_(S.chain_a())
    + f"""SELECT c.customer_id, f.months, c.best_month FROM
  (SELECT customer_id, arg_max(month_id, (incremental_revenue, -month_id)) AS best_month FROM fact GROUP BY 1) c
  JOIN (SELECT customer_id, COUNT(*) AS months FROM fact GROUP BY 1) f USING (customer_id)
  WHERE f.months >= (SELECT COUNT(*) / 40 FROM ({SUMMARY_MONTH_SQL}))""",
)
def q_display_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gold tables under their business names, joined through SQL."""
    fact = chain(spark, sf_dir).fact
    files.register_views(
        {"fact_customer_month_incrementality": fact, "agg_incrementality_month": summary.by_month(fact, exact=True)}
    )
    return spark.sql(
        """SELECT customer_id, COUNT(*) AS months,
  max_by(month_id, struct(incremental_revenue, -month_id)) AS best_month
FROM `Fact Customer Month Incrementality` GROUP BY customer_id
HAVING COUNT(*) >= (SELECT COUNT(*) / 40 FROM `Agg Incrementality Month`)"""
    )


# ---------------------------------------------------------------- B


@register("silver_customer", S.with_(S.BINDING_A) + "SELECT * FROM dim_customer")
def q_silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customer(binding_a(spark, sf_dir).customers)


@register(
    "silver_date",
    S.with_(S.BINDING_A, S.DATES)
    + "SELECT month_id, COUNT(*) AS days, MIN(date) AS first_day, MAX(date_id) AS last_day_id FROM dim_date GROUP BY month_id",
)
def q_silver_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: a calendar that arrives as text with a column too many, typed, by month."""
    raw = binding_a(spark, sf_dir).dates.select(F.col("date").alias("d"), "date_id", "month_id")
    text = raw.select(
        F.col("d").cast("string").alias("date"),
        F.col("date_id").cast("string").alias("date_id"),
        F.col("month_id").cast("string").alias("month_id"),
        F.dayofweek("d").alias("weekday"),
    )
    return silver.date(text).groupBy("month_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"), F.max("date_id").alias("last_day_id")
    )


@register(
    "silver_transaction",
    S.with_(S.BINDING_A)
    + f"""SELECT transaction_id, customer_id, strftime(transaction_ts, '{SQL_TS_FMT}') AS transaction_ts, channel,
  revenue, items, transaction_date, date_id, month_id FROM fact_transaction""",
)
def q_silver_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver.transaction(binding_a(spark, sf_dir).transactions)
    return t.withColumn("transaction_ts", F.date_format("transaction_ts", TS_FMT))


@register(
    "silver_exposure",
    S.with_(S.BINDING_A)
    + f"""SELECT exposure_id, customer_id, strftime(exposure_ts, '{SQL_TS_FMT}') AS exposure_ts, message_channel,
  campaign_name, exposure_date, date_id, month_id FROM fact_crm_exposure""",
)
def q_silver_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responder truth column of the bronze table is dropped."""
    bronze = binding_a(spark, sf_dir).exposures.withColumn(
        "is_responder", (F.col("exposure_id") % 2).cast("int")
    )
    e = silver.exposure(bronze)
    return e.withColumn("exposure_ts", F.date_format("exposure_ts", TS_FMT))


@register("date_dim", S.with_(S.BINDING_A, S.DATES) + "SELECT * FROM dim_date")
def q_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar from the first January of the data to its last month end."""
    return binding_a(spark, sf_dir).dates


@register(
    "date_keys",
    S.with_(S.BINDING_A, S.DATES)
    + """SELECT t.transaction_id, CAST(t.transaction_ts AS DATE) AS transaction_date, d.date_id, d.month_id
FROM fact_transaction t LEFT JOIN dim_date d ON d.date = CAST(t.transaction_ts AS DATE)""",
)
def q_date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floor the purchase timestamp to a day and attach the date keys."""
    b = binding_a(spark, sf_dir)
    tx = b.transactions.select("transaction_id", "transaction_ts")
    out = silver.attach_date_keys(tx, "transaction_ts", b.dates, "transaction_date")
    return out.select("transaction_id", "transaction_date", "date_id", "month_id")


@register(
    "quantile_flags",
    S.with_(S.BINDING_A)
    + "SELECT customer_id, value_score, activity_score, is_active, is_high_value FROM dim_customer",
)
def q_quantile_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High value = score >= 70th percentile, active = >= 50th (exact)."""
    c = binding_a(spark, sf_dir).customers
    return c.select("customer_id", "value_score", "activity_score", "is_active", "is_high_value")


@register(
    "quantile_thresholds",
    S.with_(S.BINDING_A)
    + """SELECT ROUND(hv, 6) AS value_p70, ROUND(ac, 6) AS activity_p50 FROM a_q""",
)
def q_quantile_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 thresholds: linear-interpolation quantiles computed without gathering."""
    from beforeafter.sources.bindings import table

    cust = table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("value_score"), "c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    n = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    x = cust.join(n, cust.c_custkey == n.o_custkey, "left").select(
        "value_score", F.coalesce("n", F.lit(0)).cast("double").alias("activity_score")
    )
    hv = silver.exact_quantile(x, "value_score", 0.7, "value_p70")
    ac = silver.exact_quantile(x, "activity_score", 0.5, "activity_p50")
    return round_cols(hv.crossJoin(ac), {"value_p70": 6, "activity_p50": 6})
