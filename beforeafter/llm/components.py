"""Connected components of an edge list as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.common import stage


#: Keys that may be joined by broadcast as too frequent for one task.
HUBS = 10_000


def join_hubs(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``, no key's rows gathered in one task.

    ``table`` has one row per key, without nulls, and in ``n`` at least the number
    of the key's rows; ``n`` adds up to at most ``total`` and is not returned.  A key
    with more than ``total / HUBS`` rows is a hub.  There are at most ``HUBS`` of
    them, so they travel as a broadcast of that bound and their rows stay where they
    are; the rest is shuffled.  ``rows`` is read twice, so store it first.
    """
    most = total // HUBS
    added = [c for c in table.columns if c not in (key, "n")]
    hub = F.broadcast(table.where(F.col("n") > most).drop("n").withColumn("__hub", F.lit(True)))
    marked = rows.join(hub, key, "left")
    rest = marked.where(F.col("__hub").isNull()).drop("__hub", *added)
    return (
        marked.where(F.col("__hub"))
        .drop("__hub")
        .unionByName(rest.join(table.where(F.col("n") <= most).drop("n"), key))
    )


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns a, b); root is the
    smallest node reachable.  Null ends and self loops are ignored; no edges, no
    rows.

    Alternates the large-star and small-star steps: each node's neighbours are
    tied to their smallest one, until nothing changes (a number of rounds that
    grows with the logarithm of the longest chain).  The minimum of a node's
    neighbours is aggregated before it is joined, and the edges of a hub are joined
    where they are (``join_hubs``), so the hub of a large group is not gathered in
    one task; every round is written to the shared folder, so that lineage stays
    short and survives lost executors.  ``max_rounds`` is a guard
    against a fault; a run that reaches it fails and returns nothing.
    """
    pairs = edges.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    pairs = stage(pairs.distinct(), "cc-edges")
    before = None
    for _ in range(max_rounds):
        # large star: neighbours above a node go to the least of it and its neighbours
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        above = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))  # u below v
        large = join_hubs(above, least, "u", 2 * pairs.count()).where("v != m")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "cc-large")
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_hubs(large, least, "u", large.count()).select(F.col("v").alias("x"), F.col("m"), F.col("u"))
        pairs = stage(
            small.where("x != m")
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "cc-round",
        )
        # fixed point: the same set of edges as after the last round
        now = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")
        ).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
