"""Conforming (silver) operators: typed projections, date dimension, date keys
and quantile flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.operators.quantiles import exact_quantiles, exact_quantiles_of
from beforeafter.sources import schemas


def _conform(df: DataFrame, schema, keep: Iterable[str]) -> DataFrame:
    keep = list(keep)
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in keep]
    )


def customer(df: DataFrame) -> DataFrame:
    """B1: typed customer dimension."""
    return _conform(df, schemas.DIM_CUSTOMER, [f.name for f in schemas.DIM_CUSTOMER.fields])


def date(df: DataFrame) -> DataFrame:
    """B2: typed date dimension."""
    return _conform(df, schemas.DIM_DATE, [f.name for f in schemas.DIM_DATE.fields])


def transaction(df: DataFrame) -> DataFrame:
    """Typed purchase fact (columns absent from ``df`` are skipped)."""
    return _conform(df, schemas.FACT_TRANSACTION, df.columns)


def exposure(df: DataFrame) -> DataFrame:
    """Typed contact fact; the synthetic ``is_responder`` truth column is dropped."""
    cols = [c for c in df.columns if c != "is_responder"]
    return _conform(df, schemas.FACT_CRM_EXPOSURE, cols)


def date_dim(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day between the ``start`` and ``end`` columns of each
    row of ``bounds`` (normally one row), with yyyyMMdd and yyyyMM keys."""
    d = bounds.select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    return d.select(
        "date",
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"),
        F.date_format("date", "yyyyMM").cast("int").alias("month_id"),
    )


def date_dim_range(spark, start: str, end: str) -> DataFrame:
    """B5 for literal bounds (ISO dates)."""
    return date_dim(
        spark.range(1).select(
            F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
        )
    )


def attach_date_keys(df: DataFrame, ts_col: str, dates: DataFrame, date_col: str) -> DataFrame:
    """Floor a timestamp to its day and left-join the date dimension.

    The date dimension is a calendar (one row per day of the covered span), so
    its size is bounded by the span, not by the facts: it is broadcast.
    """
    keyed = df.withColumn(date_col, F.to_date(F.col(ts_col)))
    cal = dates.select(F.col("date").alias("__d"), "date_id", "month_id")
    out = keyed.drop("date_id", "month_id").join(
        F.broadcast(cal), keyed[date_col] == cal["__d"], "left"
    )
    return out.drop("__d")


def exact_quantile(df: DataFrame, col: str, p: float, alias: str, accuracy: int = 100_000) -> DataFrame:
    """One-row frame with the linear-interpolation quantile of ``col`` (numpy's
    default), computed without gathering the column (see ``quantiles``)."""
    return exact_quantiles(df, col, {alias: p}, accuracy=accuracy)


def quantile_flags(
    df: DataFrame,
    specs: list[tuple[str, float, str]],
    method: str = "exact",
) -> DataFrame:
    """``out = 1`` when ``col >= quantile(col, q)`` else 0, per (col, q, out).

    ``method="exact"`` uses :func:`exact_quantile`; ``"approx"`` uses
    ``percentile_approx`` only (bounded memory, rank error 1e-4).
    """
    thr_specs = [(col, q, f"__thr_{name}") for col, q, name in specs]
    if method == "approx":
        thr = df.agg(*[F.percentile_approx(F.col(c).cast("double"), q, 10_000).alias(a) for c, q, a in thr_specs])
    elif method == "exact":
        thr = exact_quantiles_of(df, thr_specs)
    else:
        raise ValueError(f"unknown method {method!r}")
    # One row of thresholds.
    out = df.crossJoin(F.broadcast(thr))
    for (col, _, name), (_, _, thr_name) in zip(specs, thr_specs):
        out = out.withColumn(name, F.when(F.col(col) >= F.col(thr_name), 1).otherwise(0).cast("int"))
    return out.drop(*[a for _, _, a in thr_specs])
