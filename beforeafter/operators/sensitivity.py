"""Window sensitivity (J7) and sign stability.

All PRE and POST lengths of the grid come from one running sum per customer:
its windows share the day before the anchor, so seven lookups per anchor give
three PRE and three POST sums, whatever the lengths; then every (PRE, POST) pair
is a projection, stacked to long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.config import SENSITIVITY_POST_DAYS, SENSITIVITY_PRE_DAYS
from beforeafter.functions.numeric import rsum
from beforeafter.operators.running import window_totals
from beforeafter.operators.windows import ANCHOR_KEYS


def totals(
    anchor_df: DataFrame,
    days: DataFrame,
    customers: DataFrame,
    pres: tuple[int, ...] = SENSITIVITY_PRE_DAYS,
    posts: tuple[int, ...] = SENSITIVITY_POST_DAYS,
) -> DataFrame:
    """One row per anchor of a known customer with the totals of every PRE and POST
    window.  Anchors and days are counted to size the tasks: pass stored tables."""
    wins = {f"pre{p}": (-p, -1) for p in pres} | {f"post{q}": (0, q - 1) for q in posts}
    known = anchor_df.join(customers.select("customer_id"), "customer_id", "left_semi")
    return window_totals(known, days, wins, rows=anchor_df.count() + days.count())


def stacked(
    found: DataFrame,
    pres: tuple[int, ...] = SENSITIVITY_PRE_DAYS,
    posts: tuple[int, ...] = SENSITIVITY_POST_DAYS,
    keys: list[str] | None = None,
) -> DataFrame:
    """Long form of ``totals``: its ``keys`` once per (pre, post) pair with the
    incremental revenue and transactions of that pair."""
    keys = keys or ANCHOR_KEYS
    pairs = []
    for p in pres:
        for q in posts:
            rev = (F.col(f"post{q}_revenue") / q - F.col(f"pre{p}_revenue") / p) * q
            txn = (F.col(f"post{q}_txn_cnt") / q - F.col(f"pre{p}_txn_cnt") / p) * q
            pairs.append(
                F.struct(
                    F.lit(p).alias("pre_days"),
                    F.lit(q).alias("post_days"),
                    rev.alias("incremental_revenue"),
                    txn.alias("incremental_transactions"),
                )
            )
    long = found.select(*keys, F.explode(F.array(*pairs)).alias("__p"))
    return long.select(*keys, "__p.*")


def per_anchor(
    anchor_df: DataFrame,
    days: DataFrame,
    customers: DataFrame,
    pres: tuple[int, ...] = SENSITIVITY_PRE_DAYS,
    posts: tuple[int, ...] = SENSITIVITY_POST_DAYS,
) -> DataFrame:
    """Long form: one row per anchor of a known customer and (pre, post) pair
    with the incremental revenue and transactions of that pair."""
    return stacked(totals(anchor_df, days, customers, pres, posts), pres, posts)


def grid(long: DataFrame, by: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Totals per (pre, post) pair (and per ``by`` group)."""
    return long.groupBy(*(by or []), "pre_days", "post_days").agg(
        F.count(F.lit(1)).alias("customer_months"),
        rsum("incremental_revenue", exact).alias("incremental_revenue"),
        rsum("incremental_transactions", exact).alias("incremental_transactions"),
    )


def stability(grid_df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sign counts of the incremental revenue across the grid; a group is
    stable when it is never positive and negative at once."""
    r = F.col("incremental_revenue")
    out = grid_df.groupBy(*(by or [])).agg(
        F.count(F.when(r > 0, 1)).alias("n_positive"),
        F.count(F.when(r < 0, 1)).alias("n_negative"),
        F.count(F.when(r == 0, 1)).alias("n_zero"),
    )
    return out.withColumn("stable", ~((F.col("n_positive") > 0) & (F.col("n_negative") > 0)))
