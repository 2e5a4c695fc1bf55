"""Fixed-precision presentation shared by the Spark queries and the oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def round_cols(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named double columns, keep order and names."""
    return df.select(
        *[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def sql_round(body: str, digits: dict[str, int]) -> str:
    """Wrap a SQL query so the named columns are rounded (DuckDB ``REPLACE``)."""
    if not digits:
        return body
    rep = ", ".join(f"ROUND({c}, {d}) AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) AS q"


FACT_DOUBLES = [
    "pre_revenue",
    "post_revenue",
    "pre_rev_per_day",
    "post_rev_per_day",
    "pre_txn_per_day",
    "post_txn_per_day",
    "pre_freq",
    "post_freq",
    "pre_aov",
    "post_aov",
    "incremental_revenue",
    "incremental_transactions",
    "incremental_freq_points",
    "delta_aov",
]


def six(cols: list[str]) -> dict[str, int]:
    return {c: 6 for c in cols}
