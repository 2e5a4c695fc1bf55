"""Golden figures of the test bindings (FIXTURES.md, sf 0.001): both bindings,
default and alternative windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from beforeafter.plans.queries_core import EVENTS_CFG, EVENTS_SHORT_CFG, chain
from tests.conftest import SF_SMALL


def _figures(fact):
    r = fact.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("month_id").alias("months"),
        F.sum((F.col("pre_revenue") > 0).cast("int")).alias("pre_pos"),
        F.sum((F.col("post_revenue") > 0).cast("int")).alias("post_pos"),
        F.round(F.sum("incremental_revenue"), 4).alias("rev"),
        F.round(F.sum("incremental_transactions"), 4).alias("txn"),
    ).first()
    return r.n, r.months, r.pre_pos, r.post_pos, r.rev, r.txn


def test_orders_binding(spark):
    c = chain(spark, SF_SMALL)
    assert _figures(c.fact) == (1805, 83, 214, 50, -879263.4725, -4.25)
    flags = c.binding.customers.agg(F.sum("is_active"), F.sum("is_high_value"), F.count(F.lit(1))).first()
    assert tuple(flags) == (82, 45, 150)


def test_events_binding(spark):
    assert _figures(chain(spark, SF_SMALL, EVENTS_CFG, "b").fact)[:5] == (15, 1, 9, 14, 2136.12)
    assert _figures(chain(spark, SF_SMALL, EVENTS_SHORT_CFG, "b").fact)[:5] == (15, 1, 9, 12, 240.2343)
