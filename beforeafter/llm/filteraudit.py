"""Filter interaction audit by counting paths through the lattice of subsets.

Filters are applied one after the other; which of them have run is a subset of
all filters, and an order of the filters is a path from the empty to the full
subset.  A forward pass counts the paths that reach each subset, a backward pass
those that lead on from it.  What an edge (subset, next filter) removes depends on
nothing else, so

* a filter's removals summed over all orders are its edges' removals, each times
  the paths that reach the edge and the paths that leave it (Shapley weights);
* a step of a given order is the edge that its first filters lead to.

Documents enter as one mask of failed filters each; masks are counted per part,
after which every figure is arithmetic on at most 2^filters counts a part.

DataFrame operations only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.common import text_of, words

#: Filter letter and the condition, over w (array of words) and t (text), under
#: which a text fails it.  E, repeated texts, looks at the whole table.
TEXT_FILTERS: list[tuple[str, str]] = [
    ("A", "size(w) < 100"),
    ("B", "100 * size(array_distinct(w)) < 80 * size(w)"),
    ("C", "100 * (char_length(t) - char_length(regexp_replace(t, '[A-Z]+', ''))) > 10 * char_length(t)"),
    ("D", "t rlike '[#$%&*|]'"),
]
REPEATED = "E"
FILTERS = "".join(f for f, _ in TEXT_FILTERS) + REPEATED


@dataclass(frozen=True)
class Lattice:
    """Paths through the subsets of ``n`` filters: ``reach[s]`` from the empty
    set to s, ``leave[s]`` from s to the full set."""

    n: int
    reach: tuple[int, ...]
    leave: tuple[int, ...]

    @classmethod
    def of(cls, n: int) -> Lattice:
        full = (1 << n) - 1
        reach, leave = [0] * (full + 1), [0] * (full + 1)
        reach[0] = leave[full] = 1
        for s in range(full + 1):  # a subset comes after all it contains
            for f in range(n):
                if not s >> f & 1:
                    reach[s | 1 << f] += reach[s]
        for s in range(full, -1, -1):
            for f in range(n):
                if not s >> f & 1:
                    leave[s] += leave[s | 1 << f]
        return cls(n, tuple(reach), tuple(leave))

    def edges(self) -> list[tuple[int, int, int]]:
        """(subset that has run, next filter, paths over this edge)."""
        return [
            (s, f, self.reach[s] * self.leave[s | 1 << f])
            for s in range(1 << self.n)
            for f in range(self.n)
            if not s >> f & 1
        ]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows, rows labelled quality 1 and rows
    labelled toxic 1 for every part (language, null as empty) and mask of failed
    filters; bit b of the mask is the b-th letter of ``FILTERS``.

    Null and empty texts have no words.  A text is repeated if a row with a smaller
    doc_id holds the same bytes (compared by SHA-256); repeated rows with one doc_id
    do not repeat each other, and a null doc_id is neither smaller nor larger.  If
    a doc_id has several labels, one that says 1 is enough.
    """
    t = docs.select("doc_id", text_of("lang").alias("part"), text_of("text").alias("t"))
    own = F.lit(0)
    for b, (_, condition) in enumerate(TEXT_FILTERS):
        own = own + F.when(F.expr(condition), 1 << b).otherwise(0)
    judged = t.withColumn("w", words(F.col("t"))).select(
        "doc_id", "part", own.alias("mask"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest")
    )
    # equal texts fail the same text filters, so a digest has one mask
    held = judged.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = held.where("doc_id is not null").join(marks, "doc_id", "left")
    share = lambda c: (F.coalesce(F.col(c), F.lit(0)) * F.col("n")).cast("long").alias(c)
    known = known.select("digest", "doc_id", "part", "mask", "n", share("good"), share("toxic"))
    # of each text and part: everything, and the rows of the smallest doc_id
    per_text = known.groupBy("digest", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")],
        F.min(F.struct("doc_id", "n", "good", "toxic")).alias("first"),
    )
    smallest = per_text.groupBy("digest").agg(F.min("first.doc_id").alias("smallest"))
    texts = per_text.join(smallest, "digest")
    leads = F.col("first.doc_id") == F.col("smallest")
    first = [F.when(leads, F.col(f"first.{c}")).otherwise(F.lit(0)).cast("long").alias(c) for c in ("n", "good", "toxic")]
    rest = [(F.col(c) - F.when(leads, F.col(f"first.{c}")).otherwise(0)).cast("long").alias(c) for c in ("n", "good", "toxic")]
    split = texts.select(
        "part",
        F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), *first),
                F.struct((F.col("mask") + (1 << FILTERS.index(REPEATED))).alias("mask"), *rest),
            )
        ).alias("x"),
    ).select("part", "x.*")
    none = F.lit(0).cast("long")
    unknown = held.where("doc_id is null").select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    return (
        split.unionByName(unknown)
        .groupBy("part", "mask")
        .agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])
    )


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for every part, order of the filters and step.

    ``counts`` is (part, mask, n, good, toxic).  kept: rows left after the step;
    removed: rows that this step takes; redundant: rows that fail its filter but
    were gone; unique_fails: rows that fail this filter only; good_lost and
    toxic_lost: labelled rows that this step takes; shapley: what its filter takes,
    summed over all orders.  No rows: no parts.
    """
    lattice = Lattice.of(len(filters))
    # every edge for every part: 2^(n-1) * n rows, whatever the number of documents
    edges = _table(
        [{"ran": r, "filter": f, "bit": 1 << f, "paths": p} for r, f, p in lattice.edges()],
        "array<struct<ran int, filter int, bit int, paths long>>",
    )
    on = counts.select("*", F.explode(edges).alias("e")).select("part", "mask", "n", "good", "toxic", "e.*")
    mask, ran, bit = F.col("mask"), F.col("ran"), F.col("bit")
    alive = mask.bitwiseAND(ran) == 0
    fails = mask.bitwiseAND(bit) != 0
    total = lambda cond, of="n": F.sum(F.when(cond, F.col(of)).otherwise(0)).cast("long")
    steps = on.groupBy("part", "ran", "filter", "paths").agg(
        total(alive & ~fails).alias("kept"),
        total(alive & fails).alias("removed"),
        total(~alive & fails).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(alive & fails, "good").alias("good_lost"),
        total(alive & fails, "toxic").alias("toxic_lost"),
    )
    weight = steps.groupBy("part", "filter").agg(F.sum(F.col("paths") * F.col("removed")).cast("long").alias("shapley"))
    figures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    uses = steps.join(weight, ["part", "filter"]).select("part", *figures, F.explode(_orders(filters)).alias("use"))
    return uses.select("part", "use.filter_order", "use.step", *figures)


def _orders(filters: str) -> Column:
    """The (order, step) pairs that use an edge (ran, filter)."""
    n = len(filters)
    used: list[list[dict]] = [[] for _ in range(n << n)]
    for order in permutations(range(n)):
        ran = 0
        for step, f in enumerate(order, 1):
            used[ran * n + f].append({"filter_order": "".join(filters[x] for x in order), "step": step})
            ran |= 1 << f
    return F.get(_table(used, "array<array<struct<filter_order string, step int>>>"), F.col("ran") * n + F.col("filter"))


def _table(values, kind: str) -> Column:
    """A fixed table as one constant."""
    return F.from_json(F.lit(json.dumps(values)), kind)
