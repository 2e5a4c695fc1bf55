"""Exact linear-interpolation quantiles (numpy's default, SQL ``percentile_cont``)
per group, without gathering a group's values in one task.

``percentile`` keeps a map of every distinct value of a group in one reducer;
for a month of a large customer base that is the month.  Here one pass of
``percentile_approx`` (bounded sketch, rank error ``1/accuracy``) brackets the
order statistics around rank ``(n-1)p`` of every probability.  A second pass counts
the distinct values inside each bracket, and keeps the count and nearest value
below it and above it, so the neighbouring rank is at hand however narrow the
bracket is.  If a rank lies farther out, the query fails instead of returning a
wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.operators.ranking import bounded

#: Groups whose brackets may be sent to every task.
MAX_GROUPS = 50_000


def _brackets(v: DataFrame, g: list[str], probs: list[float], accuracy: int) -> DataFrame:
    """Per group: count, minimum, maximum and one bracket per probability."""
    eps = 3.0 / accuracy
    at = [F.lit(x) for p in probs for x in (max(p - eps, 0.0), min(p + eps, 1.0))]
    agg = v.groupBy(*g).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
        F.percentile_approx("__v", F.array(*at), accuracy).alias("__pa"),
    )
    parts = [
        F.struct(
            F.lit(i).alias("__i"),
            F.col("__pa")[2 * i].alias("__lo"),
            F.col("__pa")[2 * i + 1].alias("__hi"),
            ((F.col("__n") - 1) * F.lit(p)).alias("__pos"),
        )
        for i, p in enumerate(probs)
    ]
    return agg.select(*g, "__n", "__min", "__max", F.array(*parts).alias("__b"))


def _quantiles(v: DataFrame, g: list[str], probs: list[float], what: str, accuracy: int) -> DataFrame:
    """``g``, ``__n``, ``__min``, ``__max`` and ``__q`` (one entry per probability)
    for rows ``g``, ``__v`` without nulls and NaN."""
    brackets = _brackets(v, g, probs, accuracy)
    side = bounded(brackets.select(*[F.col(c).alias(f"__k{k}") for k, c in enumerate(g)], "__b"), MAX_GROUPS, "groups")
    if g:
        on = None
        for k, c in enumerate(g):
            same = v[c].eqNullSafe(side[f"__k{k}"])
            on = same if on is None else on & same
        joined = v.join(side, on)
    else:
        joined = v.crossJoin(side)  # one row of brackets
    x = joined.select(*g, "__v", F.explode("__b").alias("__s")).select(*g, "__v", "__s.*")
    place = F.when(F.col("__v") < F.col("__lo"), -1).when(F.col("__v") > F.col("__hi"), 1).otherwise(0)
    counted = (
        x.withColumn("__place", place)
        .groupBy(*g, "__i", "__place", F.when(F.col("__place") == 0, F.col("__v")).alias("__key"))
        .agg(
            F.count(F.lit(1)).alias("__c"),
            F.max("__v").alias("__top"),
            F.min("__v").alias("__bottom"),
            F.max("__pos").alias("__pos"),
        )
    )
    order = Window.partitionBy(*g, "__i").orderBy("__place", F.col("__key").asc_nulls_first())
    run = F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = counted.withColumn("__end", run).withColumn("__start", F.col("__end") - F.col("__c"))
    below, above = F.col("__place") < 0, F.col("__place") > 0

    def value_at(rank: Column) -> Column:
        """The value of a rank: any inside the bracket, the last below, the first above."""
        here = (F.col("__start") <= rank) & (rank < F.col("__end"))
        known = (~below & ~above) | (below & (rank == F.col("__end") - 1)) | (above & (rank == F.col("__start")))
        return F.max(F.when(here & known, F.when(above, F.col("__bottom")).otherwise(F.col("__top"))))

    k = F.floor("__pos").cast("long")
    found = counted.groupBy(*g, "__i").agg(
        F.max("__pos").alias("__pos"), value_at(k).alias("__x0"), value_at(k + 1).alias("__x1")
    )
    part = F.col("__pos") - F.floor("__pos")
    upper = F.when(part == 0, F.col("__x0")).otherwise(F.col("__x1"))
    missed = F.raise_error(F.lit(f"quantile bracket for {what} missed its rank")).cast("double")
    q = F.when(F.col("__x0").isNull() | upper.isNull(), missed).otherwise(
        F.col("__x0") + part * (upper - F.col("__x0"))
    )
    rows = found.select(*[F.col(c).alias(f"__r{n}") for n, c in enumerate(g)], "__i", q.alias("__qv"))
    wide = rows.groupBy(*[f"__r{n}" for n in range(len(g))]).agg(
        *[F.max(F.when(F.col("__i") == i, F.col("__qv"))).alias(f"__q{i}") for i in range(len(probs))]
    )
    if not g:
        return brackets.crossJoin(wide)  # two frames of one row
    on = None
    for n, c in enumerate(g):
        same = brackets[c].eqNullSafe(wide[f"__r{n}"])
        on = same if on is None else on & same
    return brackets.join(wide, on).drop(*[f"__r{n}" for n in range(len(g))])


def _values(df: DataFrame, g: list[str], col: str) -> DataFrame:
    return df.select(*g, F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: dict[str, float],
    group_cols: list[str] | None = None,
    accuracy: int = 100_000,
    extremes: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per group with a column per ``probs`` entry (alias -> p), and the
    minimum and maximum under the names ``extremes`` if given.  ``df`` is read
    twice, for any number of probabilities."""
    g = list(group_cols or [])
    out = _quantiles(_values(df, g, col), g, list(probs.values()), col, accuracy)
    named = [F.col(f"__q{i}").alias(a) for i, a in enumerate(probs)]
    if extremes:
        named = [F.col("__min").alias(extremes[0]), F.col("__max").alias(extremes[1]), *named]
    return out.select(*g, *named)


def exact_quantiles_of(df: DataFrame, specs: list[tuple[str, float, str]], accuracy: int = 100_000) -> DataFrame:
    """One row with the quantile ``p`` of column ``col`` as ``alias`` for every
    ``(col, p, alias)`` (the columns are stacked and treated as groups)."""
    parts = [F.struct(F.lit(i).alias("__g"), F.col(c).cast("double").alias("__v")) for i, (c, _, _) in enumerate(specs)]
    v = df.select(F.explode(F.array(*parts)).alias("__s")).select("__s.*")
    v = v.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    probs = sorted({float(p) for _, p, _ in specs})
    q = _quantiles(v, ["__g"], probs, ",".join(c for c, _, _ in specs), accuracy)
    return q.agg(
        *[F.max(F.when(F.col("__g") == i, F.col(f"__q{probs.index(float(p))}"))).alias(a) for i, (_, p, a) in enumerate(specs)]
    )
