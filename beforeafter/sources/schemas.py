"""Declared schemas of the four source tables and of the gold tables.

Fixed values: column names and types must equal the method's published data
model so that CSV extracts load without inference.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Source schemas (bronze), all columns nullable.
DIM_CUSTOMER = _schema(
    ("customer_id", LongType()),
    ("signup_date", DateType()),
    ("is_active", IntegerType()),
    ("is_high_value", IntegerType()),
    ("value_score", DoubleType()),
    ("activity_score", DoubleType()),
)
DIM_DATE = _schema(
    ("date", DateType()),
    ("date_id", IntegerType()),
    ("month_id", IntegerType()),
)
FACT_TRANSACTION = _schema(
    ("transaction_id", LongType()),
    ("customer_id", LongType()),
    ("transaction_ts", TimestampType()),
    ("channel", StringType()),
    ("revenue", DoubleType()),
    ("items", IntegerType()),
    ("transaction_date", DateType()),
    ("date_id", IntegerType()),
    ("month_id", IntegerType()),
)
FACT_CRM_EXPOSURE = _schema(
    ("exposure_id", LongType()),
    ("customer_id", LongType()),
    ("exposure_ts", TimestampType()),
    ("message_channel", StringType()),
    ("campaign_name", StringType()),
    ("is_responder", IntegerType()),
    ("exposure_date", DateType()),
    ("date_id", IntegerType()),
    ("month_id", IntegerType()),
)

SCHEMAS: dict[str, StructType] = {
    "dim_customer": DIM_CUSTOMER,
    "dim_date": DIM_DATE,
    "fact_transaction": FACT_TRANSACTION,
    "fact_crm_exposure": FACT_CRM_EXPOSURE,
}

# Date / timestamp columns re-parsed after a CSV load, per table.
DATE_COLUMNS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "dim_customer": (("signup_date",), ()),
    "dim_date": (("date",), ()),
    "fact_transaction": (("transaction_date",), ("transaction_ts",)),
    "fact_crm_exposure": (("exposure_date",), ("exposure_ts",)),
}

# Gold table schemas.
AGG_MONTH = _schema(
    ("month_id", IntegerType()),
    ("exposed_customer_months", LongType()),
    ("incremental_revenue", DoubleType()),
    ("incremental_transactions", DoubleType()),
    ("avg_delta_aov", DoubleType()),
)
AGG_RFM = _schema(
    ("month_id", IntegerType()),
    ("rfm_segment", StringType()),
    ("customers", LongType()),
    ("incremental_revenue", DoubleType()),
    ("incremental_transactions", DoubleType()),
    ("avg_delta_aov", DoubleType()),
)
AGG_ACTIVE_VALUE = _schema(
    ("month_id", IntegerType()),
    ("is_active", IntegerType()),
    ("is_high_value", IntegerType()),
    ("customers", LongType()),
    ("incremental_revenue", DoubleType()),
    ("incremental_transactions", DoubleType()),
    ("avg_delta_aov", DoubleType()),
)

# Business display names of the gold tables.
DISPLAY_NAMES: dict[str, str] = {
    "fact_customer_month_incrementality": "Fact Customer Month Incrementality",
    "agg_incrementality_month": "Agg Incrementality Month",
    "agg_incrementality_rfm": "Agg Incrementality RFM",
    "agg_incrementality_active_value": "Agg Incrementality Active Value",
    "dim_customer_month_rfm": "Dim Customer Month RFM",
}
