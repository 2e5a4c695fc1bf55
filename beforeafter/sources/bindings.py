"""Bindings of the given test tables onto the method's source schema.

Binding A (orders and shipments): an order is a purchase, a returned shipment
line is a contact.  Binding B (events): a ``purchase`` event is a purchase, a
``click`` event is a contact.  Both read only
the columns they need so the parquet scans prune and push filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.operators import silver


@dataclass(frozen=True)
class Binding:
    customers: DataFrame
    dates: DataFrame
    transactions: DataFrame
    exposures: DataFrame
    # The customer keys alone, for joins that only test membership (no flags).
    customer_ids: DataFrame | None = None

    @property
    def unflagged(self) -> DataFrame:
        """Customers with null flags: for facts whose flags nobody reads, so that
        no quantile is computed for them."""
        none = F.lit(None).cast("int")
        return self.customer_ids.select("customer_id", none.alias("is_active"), none.alias("is_high_value"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_keys(ts: F.Column) -> tuple[F.Column, F.Column]:
    date_id = (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")
    month_id = (F.year(ts) * 100 + F.month(ts)).cast("int")
    return date_id, month_id


def customers_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    per_cust = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("o_orderdate")).alias("s")
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    x = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.coalesce("s", F.lit("1995-01-01").cast("date")).alias("signup_date"),
        F.col("c_acctbal").alias("value_score"),
        F.coalesce("n", F.lit(0)).cast("double").alias("activity_score"),
    )
    x = silver.quantile_flags(
        x, [("activity_score", 0.5, "is_active"), ("value_score", 0.7, "is_high_value")]
    )
    return x.select(
        "customer_id", "signup_date", "is_active", "is_high_value", "value_score", "activity_score"
    )


def transactions_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    qty = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_quantity")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("q"))
    )
    date_id, month_id = _day_keys(F.col("o_orderdate"))
    return orders.join(qty, qty.l_orderkey == orders.o_orderkey, "left").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_ts"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "online")
        .otherwise("offline")
        .alias("channel"),
        F.col("o_totalprice").alias("revenue"),
        F.coalesce("q", F.lit(0.0)).cast("int").alias("items"),
        F.to_date("o_orderdate").alias("transaction_date"),
        date_id.alias("date_id"),
        month_id.alias("month_id"),
    )


def exposures_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_shipdate", "l_linestatus", "l_returnflag")
        .where(F.col("l_returnflag") == "R")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    date_id, month_id = _day_keys(F.col("l_shipdate"))
    ln = F.col("l_linenumber") % 3
    return li.join(orders, orders.o_orderkey == li.l_orderkey, "inner").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("exposure_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").alias("exposure_ts"),
        F.when(ln == 0, "email").when(ln == 1, "sms").otherwise("push").alias("message_channel"),
        F.when(F.col("l_linestatus") == "O", "Promo_A").otherwise("Promo_B").alias("campaign_name"),
        F.to_date("l_shipdate").alias("exposure_date"),
        date_id.alias("date_id"),
        month_id.alias("month_id"),
    )


def dates_between(*days: DataFrame) -> DataFrame:
    """Calendar from the first January of the data to the last month end.  Each of
    ``days`` is a frame with one date column ``d``; only its extremes are kept."""
    ends = None
    for frame in days:
        own = frame.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        ends = own if ends is None else ends.unionByName(own)
    bounds = ends.agg(F.trunc(F.min("lo"), "year").alias("start"), F.last_day(F.max("hi")).alias("end"))
    return silver.date_dim(bounds)


def binding_a(spark: SparkSession, sf_dir: str) -> Binding:
    # the calendar needs the bare date columns only, not the joins of the facts
    ordered = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    shipped = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.to_date("l_shipdate").alias("d")
    )
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    return Binding(
        customers_a(spark, sf_dir),
        dates_between(ordered, shipped),
        transactions_a(spark, sf_dir),
        exposures_a(spark, sf_dir),
        ids,
    )


def transactions_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    _, month_id = _day_keys(F.col("ts"))
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("transaction_date"),
        F.col("value").alias("revenue"),
        month_id.alias("month_id"),
    )


def exposures_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    _, month_id = _day_keys(F.col("ts"))
    return ev.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("exposure_id"),
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("exposure_date"),
        month_id.alias("month_id"),
    )


def binding_b(spark: SparkSession, sf_dir: str) -> Binding:
    tx = transactions_b(spark, sf_dir)
    ex = exposures_b(spark, sf_dir)
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    days = dates_between(
        tx.select(F.col("transaction_date").alias("d")), ex.select(F.col("exposure_date").alias("d"))
    )
    return Binding(customers_a(spark, sf_dir), days, tx, ex, ids)
