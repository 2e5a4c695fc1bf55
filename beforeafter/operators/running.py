"""Windows by running totals: any number of windows per anchor, however long.

``windows.window_aggregates`` pairs an anchor with every purchase day of its widest
window.  Here nothing is paired.  A customer's purchase days become running totals
(transactions, revenue, active days up to a day), and a window ``[lo, hi]`` is the
total at ``hi`` less the total at ``lo - 1``: one lookup per window edge, and windows
that share an edge share the lookup.  A lookup is a row of its own in the customer's
order of days, so one shuffle by customer and one running sum answer all of them.

Distinct transaction ids need one correction.  The stream counts an occurrence when
its id has no earlier one (``n_new``) or as a repeat of a previous day.  A window
counts a repeat only if the previous day is before the window, so repeats whose both
days lie inside must be taken off.  For windows of one length L these are the windows
whose first day is in ``[day - L + 1, prev_day]``; a +n and a -n event at the ends of
that range and a running sum over them give the number to take off at any ``lo``.

A customer's rows are at most a few per day of the calendar and per anchor edge, so
the order of a customer with a third of all purchases stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.functions.numeric import ROW_DECIMALS
from beforeafter.operators.windows import ANCHOR_KEYS
from beforeafter.session import spread

_MONEY = f"decimal(28,{ROW_DECIMALS})"


def window_totals(
    anchor_df: DataFrame,
    days: DataFrame,
    windows: dict[str, tuple[int, int]],
    anchor_col: str = "anchor_exposure_date",
    keys: list[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """``{name}_txn_cnt``, ``{name}_revenue`` and ``{name}_active_days`` of every
    window ``(lo, hi)`` per row of ``anchor_df``, as ``windows.window_aggregates``
    returns them, from running totals over ``days`` (``windows.purchase_days``).

    ``keys`` (with ``customer_id``) and the anchor date tell anchors apart; equal rows
    give one row.  An anchor without date or customer has empty windows.  A day's
    revenue is rounded to ``ROW_DECIMALS`` decimals, as totals are subtracted and a
    double would keep what later days added; a revenue that is no finite number or
    has more than 22 digits before the point fails the query.

    ``rows`` is about how many rows both frames have together; if given, the tasks
    follow it (``session.spread``), as a task holds the totals of its anchors.
    """
    keys = keys or ANCHOR_KEYS
    for name, (lo, hi) in windows.items():
        if lo > hi:
            raise ValueError(f"window {name} ends before it begins")
    lengths = sorted({hi - lo + 1 for lo, hi in windows.values()})
    edges = sorted({e for lo, hi in windows.values() for e in (lo - 1, hi)})
    inside = [f"__in_{n}" for n in lengths]
    zero, no_money = F.lit(0).cast("long"), F.lit(None).cast(_MONEY)

    def row(at, new=zero, money=no_money, active=zero, off=zero, length=None, edge=F.lit(None).cast("int")):
        """One row of the running sums, a lookup if it has an ``edge``; ``off`` is taken
        off windows of ``length`` days."""
        parts = [edge.alias("__edge"), at.alias("__at"), new.alias("__new"), money.alias("__money"), active.alias("__active")]
        return F.struct(*parts, *[(off if n == length else zero).alias(c) for n, c in zip(lengths, inside)])

    repeat, many = F.col("__d.is_repeat"), F.col("__d.n_occ")
    bought_on, before = F.col("__d.day"), F.col("__d.prev_day")
    added = row(
        bought_on,
        F.when(repeat, many).otherwise(F.col("__d.n_new")),
        F.when(~repeat, F.col("__d.revenue")).cast(_MONEY),
        F.when(repeat, 0).otherwise(1).cast("long"),
    )
    # repeats that lie inside a window of n days, by the day before its first
    taken = [
        F.when(repeat & (F.datediff(bought_on, before) < n), row(at, off=off, length=n))
        for n in lengths
        for at, off in ((F.date_sub(bought_on, n), many), (before, -many))
    ]
    events = F.filter(F.array(added, *taken), lambda x: x.isNotNull())
    asked = F.array(*[row(F.date_add("__a", e), edge=F.lit(e)) for e in edges])
    named = list(dict.fromkeys(["customer_id", *keys]))
    bought = days.where(F.col("customer_id").isNotNull()).select(
        "customer_id", F.struct("day", "prev_day", "is_repeat", "n_new", "n_occ", "revenue").alias("__d")
    )
    # anchors and days move to their customer as they are and become lookups and events there
    both = anchor_df.select(*named, F.col(anchor_col).alias("__a")).unionByName(bought, allowMissingColumns=True)
    both = both.repartition("customer_id") if rows is None else spread(both, rows, "customer_id")
    lines = both.select(*named, "__a", F.explode(F.when(F.col("__d").isNull(), asked).otherwise(events)).alias("__e"))
    lines = lines.select(*named, "__a", "__e.*")
    # rows of a day before the lookups of that day
    order = Window.partitionBy("customer_id").orderBy(F.col("__at").asc_nulls_first(), F.col("__edge").asc_nulls_first())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ["__new", "__money", "__active", *inside]
    found = lines.select(*named, "__a", "__edge", *[F.sum(c).over(so_far).alias(c) for c in totals])
    out = []
    for name, (lo, hi) in windows.items():
        last, first = F.col("__edge") == hi, F.col("__edge") == lo - 1
        total = lambda c, less=None: F.sum(F.when(last, c).when(first, -c if less is None else -c - less))  # noqa: E731, B023
        out += [
            total(F.col("__new"), F.col(f"__in_{hi - lo + 1}")).alias(f"{name}_txn_cnt"),
            F.coalesce(total(F.col("__money")).cast("double"), F.lit(0.0)).alias(f"{name}_revenue"),
            total(F.col("__active")).alias(f"{name}_active_days"),
        ]
    # a customer's rows are together already
    per = found.where(F.col("__edge").isNotNull()).groupBy(*named, "__a").agg(*out)
    return per.withColumnRenamed("__a", anchor_col).drop(*[c for c in named if c not in keys])
