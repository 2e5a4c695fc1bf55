"""Mixing sources to target weights with exact quotas.

A document's *key* is a keyed hash; sorting a source by key permutes it, and the
first hexadecimal digits of the key cut the permuted source into blocks.  A
source's quota is a number of block slots: every block once per full pass over
the source, then the leading blocks of one more pass, the last of them cut where
the target is reached.  A splitting tree hands the slots to output shards: the
root holds every slot, each node gives its left child a multivariate
hypergeometric draw of its slots (as if they were shuffled and cut), and a leaf's
counts are the quotas of one shard.  Shards draw consecutive, hence disjoint,
slots of each source and are shuffled locally.

A document's places are the handed slots that hold its block, and in the slot at
the edge a comparison of its key with one cut per source; how often it is drawn is
the number of its places.  Counting them neither sorts nor joins texts.  DataFrame
operations only; the tree works on one row of counts per source.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.llm.common import WORD_PATTERN, broadcast_if_small, free_name, stage, text_of, words

#: Hexadecimal digits of the key that name a block: 4096 blocks in each source.
BLOCK_DIGITS = 3
MAX_TIMES = 3


def size_of(text: str = "text") -> Column:
    """Words of a text; null and empty texts have none."""
    return F.size(words(text_of(text))).cast("long")


def key_of(seed: int) -> Column:
    """Hash that orders a source's documents.  Rows with the same doc_id share it
    and are drawn together; rows without one go by their text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(text_of("text").cast("binary"))))
    return F.md5(F.concat(F.lit(f"{seed}:"), name))


def targets(sources: DataFrame, max_times: int = MAX_TIMES) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources in code-point order, null last, weigh 1, 2, 3, repeating, and share the
    total size.  A target stops at ``max_times`` its source's size and the excess is
    shared by weight again until none is above: in the order of size per weight, a
    source is at its limit if the level that remains for it and all after it is no
    lower.  The comparisons are exact.  One row per source, numbered in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("decimal(20,0)")
    size = F.col("source_size").cast("decimal(20,0)")
    whole = Window.partitionBy()
    rows = sources.withColumn("_w", weight).withColumn("_cap", (size * max_times).cast("decimal(20,0)"))
    # cap / weight in order; equal ratios reach their limit together
    by_ratio = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(size).over(whole)
    rows = (
        rows.withColumn("_total", total)
        .withColumn("_weights", F.sum("_w").over(whole))
        .withColumn("_words_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weight_left", F.col("_weights") - F.coalesce(F.sum("_w").over(before), F.lit(0)))
        .withColumn(
            "_full",
            (F.col("_cap").cast("decimal(19,0)") * F.col("_weight_left").cast("decimal(19,0)"))
            <= (F.col("_w").cast("decimal(19,0)") * F.col("_words_left").cast("decimal(19,0)")),
        )
    )
    words_left = F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(whole), F.lit(0))
    weight_left = F.col("_weights") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_w"))).over(whole), F.lit(0))
    level = words_left.cast("double") / weight_left.cast("double")
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_w").cast("double") * level)
    return rows.select("source", "source_size", target.alias("target"))


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source for each shard: an array (sources, shards) whose rows
    sum to ``quotas`` and whose columns differ by at most one in sum.

    A node that serves k shards gives the half with k // 2 of them its share of the
    slots, drawn without replacement.  Totals up to 10^9 slots.
    """
    out = np.zeros((len(quotas), shards), np.int64)
    total = sum(quotas)
    ends = [total * k // shards for k in range(shards + 1)]

    def go(have: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = have
            return
        mid = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        take = ends[mid] - ends[low]
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if have.sum() else have
        go(left, low, mid)
        go(have - left, mid, high)

    if len(quotas):
        go(np.array(quotas, np.int64), 0, shards)
    return out


class Mixture:
    """The plan of a mixture: a staged frame of documents without texts
    (``sized``: doc_id, source, key, size) and one row per source (``cuts``)."""

    def __init__(self, docs: DataFrame, seed: int = 0, shards: int = 8, max_times: int = MAX_TIMES):
        self.docs, self.seed, self.shards, self.max_times = docs, seed, shards, max_times
        self.blocks = 16**BLOCK_DIGITS
        self.sized = stage(
            docs.select("doc_id", "source", key_of(seed).alias("key"), size_of().alias("size")), "mix-sized"
        )
        self.cuts = self._cuts()
        self._handed: DataFrame | None = None

    def _cuts(self) -> DataFrame:
        block = F.conv(F.substring("key", 1, BLOCK_DIGITS), 16, 10).cast("int")
        sums = stage(
            self.sized.groupBy("source", block.alias("block")).agg(F.sum("size").alias("size")), "mix-blocks"
        )
        found = targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), self.max_times)
        # full passes, and words wanted from one more pass
        passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        found = stage(
            found.withColumn("passes", F.least(passes, F.lit(self.max_times)).cast("int")).withColumn(
                "rest", F.col("target") - F.col("passes") * F.col("source_size")
            ),
            "mix-targets",
        )
        small = broadcast_if_small(found.withColumnRenamed("source", "_source"))
        # the block in which the last pass reaches the target
        in_order = Window.partitionBy("source").orderBy("block")  # at most 4096 rows
        run = F.sum("size").over(in_order)
        edge = (
            sums.withColumn("upto", run)
            .join(small, F.col("source").eqNullSafe(F.col("_source")))
            .where("upto > rest")
            .groupBy("_source")
            .agg(
                F.min("block").alias("edge"),
                F.min_by(F.col("upto") - F.col("size"), "block").alias("before"),
                F.first("rest").alias("wanted"),
            )
        )
        edge = stage(edge, "mix-edges")
        # inside that block: the longest run of whole documents that stays within the target
        by_key = Window.partitionBy("source").orderBy("key")  # rows with one key go together
        inside = (
            self.sized.withColumn("_block", block)
            .join(
                broadcast_if_small(edge),
                F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("edge")),
            )
            .withColumn("upto", F.col("before") + F.sum("size").over(by_key))
            .where("upto <= wanted")
            .groupBy("_source")
            .agg(F.max("key").alias("cut"), F.max("upto").alias("reached"))
        )
        cut = edge.join(inside.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left").select(
            "_source",
            "edge",
            F.coalesce("cut", F.lpad(F.lower(F.hex("edge")), BLOCK_DIGITS, "0")).alias("cut"),
            (F.col("wanted") - F.coalesce("reached", "before")).alias("gap"),
        )
        cut = stage(cut, "mix-cuts")
        # one more document whose size comes nearest to what is missing, if it helps
        off = F.abs(F.col("weight") - F.col("gap"))
        nearest = (
            self.sized.join(
                broadcast_if_small(cut), F.col("source").eqNullSafe(F.col("_source")) & (F.col("key") > F.col("cut"))
            )
            .groupBy("_source", "key")
            .agg(F.sum("size").alias("weight"), F.first("gap").alias("gap"))
            .where(off < F.col("gap"))
            .groupBy("_source")
            .agg(F.min(F.struct(off.alias("off"), F.col("key"))).alias("best"))
            .select(F.col("_source").alias("_s"), F.col("best.key").alias("extra"))
        )
        named = cut.join(nearest, F.col("_source").eqNullSafe(F.col("_s")), "left").select(
            F.col("_source").alias("_of"), "edge", "cut", "extra"
        )
        return stage(
            found.join(named, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of", "rest"), "mix-sources"
        )

    def _place(self, rows: DataFrame, key: Column) -> DataFrame:
        """``rows`` (with a source column) with ``places``: a struct (copy, shard)
        for each slot that the tree hands to a shard and that draws the row, and the
        row of its source as a struct ``_cut``.

        A copy's slot is its block in that pass; the slot at the edge draws the keys
        up to the cut and the extra document.  A slot beyond the last shard's is
        nobody's."""
        cuts = self.handed().select(F.struct(*self.handed().columns).alias("_cut"))
        c = F.col("_cut")
        again = F.coalesce((key <= c["cut"]) | (key == F.coalesce(c["extra"], F.lit(""))), F.lit(False))
        block = F.conv(F.substring(key, 1, BLOCK_DIGITS), 16, 10).cast("int")

        def slot(k: Column) -> Column:
            return k * self.blocks + F.when(k == c["passes"], F.least(block, c["edge"])).otherwise(block)

        def shard(k: Column) -> Column:
            return F.size(F.filter(c["upto"], lambda end: end <= slot(k)))

        passes = F.filter(F.sequence(F.lit(0), c["passes"]), lambda k: (k < c["passes"]) | again)
        places = F.transform(passes, lambda k: F.struct(k.alias("copy"), shard(k).alias("shard")))
        return rows.join(broadcast_if_small(cuts), F.col("source").eqNullSafe(c["source"])).withColumn(
            "places", F.filter(places, lambda p: p["shard"] < self.shards)
        )

    def plan(self) -> DataFrame:
        """doc_id, size, source_size, target, times for every row of the input;
        times counts the slots of all shards that draw the row."""
        rows = self._place(self.sized, F.col("key"))
        return rows.select("doc_id", "size", "_cut.source_size", "_cut.target", F.size("places").alias("times"))

    def quotas(self) -> list[tuple[str | None, list[int]]]:
        """Block slots of each source per shard.  Collects one row of two integers
        per source."""
        slots = F.col("passes") * F.lit(self.blocks) + F.coalesce(F.col("edge") + 1, F.lit(0))
        rows = self.cuts.select("source", slots.cast("long").alias("n")).collect()
        rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        split = split_quotas([r["n"] for r in rows], self.shards, self.seed)
        return [(r["source"], q.tolist()) for r, q in zip(rows, split)]

    def handed(self) -> DataFrame:
        """``cuts`` with ``upto``: the slot at which each shard's run of consecutive
        slots of the source ends."""
        if self._handed is None:
            text = json.dumps([{"name": s, "upto": np.cumsum(q).tolist()} for s, q in self.quotas()])
            ends = self.docs.sparkSession.range(1).select(
                F.inline(F.from_json(F.lit(text), "array<struct<name:string,upto:array<bigint>>>"))
            )
            rows = self.cuts.join(broadcast_if_small(ends), F.col("source").eqNullSafe(F.col("name"))).drop("name")
            self._handed = stage(rows, "mix-handed")
        return self._handed

    def rows(self, place: bool = True) -> DataFrame:
        """The mixture: the input's rows, each as often as drawn.  With ``place``
        two more columns, ``shard`` and ``shuffle_key``: the output shard, and the
        order inside it (``shuffled`` sorts by it)."""
        docs, shard, order = self.docs, free_name(self.docs, "shard"), free_name(self.docs, "shuffle_key")
        k = free_name(docs, "_key")
        keyed = docs.withColumn(k, key_of(self.seed))
        own = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
        placed = self._place(keyed.select(own, F.col(k).alias("_key"), F.col("source")), F.col("_key"))
        copies = placed.withColumn("_place", F.explode("places"))
        if not place:
            return copies.select("_row.*")
        return copies.select(
            "_row.*",
            F.col("_place.shard").alias(shard),
            F.md5(F.concat(F.lit(f"{self.seed}/"), F.col("_key"), F.lit("/"), F.col("_place.copy"))).alias(order),
        )

    def shuffled(self) -> DataFrame:
        """``rows`` shard after shard, each locally shuffled.  A shard's rows are
        spread over tasks by their shuffle key."""
        rows = self.rows()
        shard, order = rows.columns[-2:]
        return rows.repartitionByRange(shard, order).sortWithinPartitions(shard, order)

    def write(self, path: str) -> None:
        """Write the shards as Parquet folders ``shard=k``, each locally shuffled."""
        rows = self.shuffled()
        shard, order = rows.columns[-2:]
        rows.drop(order).write.partitionBy(shard).parquet(path)


def mix(docs: DataFrame, seed: int = 0, shards: int = 8) -> Mixture:
    """Mixture of ``docs`` (doc_id, text, source and any other columns).

    Sizes are words; the targets are those of ``targets``.  A source's drawn words
    come as near to its target as whole documents allow: full passes, the leading
    documents of its permutation, and one more that best fills the gap.  No document
    is drawn more than three times.  The same input and seed give the same mixture.
    Null and empty texts have size 0 and are drawn like their neighbours; a null
    source is a source; rows with one doc_id are drawn equally often.  No rows in,
    no rows out.
    """
    return Mixture(docs, seed, shards)
