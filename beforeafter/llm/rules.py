"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one long whose bit *b* says that rule *b* failed.  A policy is a versioned
set of rules, so applying one is ``failed & mask = 0``; which documents a rule
alone rejects, or what dropping it would change, follows from counting the masks
and never touches the texts again.

DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.common import WORD_PATTERN, free_name, text_of, words

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_exclaim",
]


def _c(name: str) -> Column:
    return F.col(name)


#: Rule name and the condition under which a document fails it, over the measures.
#: The position in this list is the rule's bit: append, never reorder.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("repeated_lines", "4 * n_dup_lines > 3 * n_lines"),
    ("shouting", "2 * n_upper > word_chars"),
    ("exclaiming", "2 * n_exclaim > n_words"),
]
BIT = {name: b for b, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
STRICT = Policy("quality-1", tuple(name for name, _ in RULES))
POLICIES = {p.version: p for p in (BASE, STRICT)}


def _removed(text: Column, pattern: str) -> Column:
    """Code points that the pattern matches."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``MEASURES`` (long, never null).

    Words are runs of anything but ASCII white space; null and empty texts have
    none.  n_repeat_words counts the words inside three-word windows that occur at
    least twice in the text; n_dup_lines the lines with a word that equal an
    earlier line; n_lines the lines with a word.  Windows are compared inside the
    row by 64-bit hash (over 10^14 texts of 500 words, one false match is expected),
    so a text is never spread over rows.  Columns of ``docs`` pass through;
    one named like a measure is replaced.
    """
    names = {m.lower() for m in MEASURES}
    docs = docs.select(*[c for c in docs.columns if c.lower() not in names])
    w, g, d, s = (free_name(docs, n) for n in ("_words", "_windows", "_doubled", "_starts"))
    text = text_of("text")
    # a condition on a measure stays above the arrays: below them, where the
    # optimizer would move it, each step of a lambda computes them anew
    here = lambda m: F.when(F.spark_partition_id() >= 0, m.cast("long"))
    # each array is a column of its own before a lambda indexes it
    split = docs.withColumn(w, words(text))
    hashed = lambda i: F.xxhash64(F.get(_c(w), i), F.get(_c(w), i + 1), F.get(_c(w), i + 2))
    windows = split.withColumn(
        g, F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), hashed))
    )
    # most texts repeat no window: only the others are sorted
    order = F.sort_array(F.arrays_zip(_c(g).alias("hash"), F.sequence(F.lit(0), F.size(g) - 1).alias("at")))
    doubled = windows.withColumn(d, F.when(F.size(F.array_distinct(g)) < F.size(g), order))
    same = lambda x, j: F.coalesce(F.get(_c(d), j)["hash"] == x["hash"], F.lit(False))
    twice = F.filter(_c(d), lambda x, j: same(x, j - 1) | same(x, j + 1))
    starts = doubled.withColumn(s, F.sort_array(F.transform(twice, lambda x: x["at"])))
    covered = F.transform(_c(s), lambda x, j: F.least(F.lit(3), F.coalesce(F.get(_c(s), j + 1) - x, F.lit(3))))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD_PATTERN))
    return starts.select(
        *docs.columns,
        here(F.size(w)).alias("n_words"),
        here(F.char_length(F.array_join(w, ""))).alias("word_chars"),
        here(_removed(text, r"[#*$%&|<>]+")).alias("n_symbols"),
        here(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        here(F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))).alias("n_repeat_words"),
        here(F.size(lines)).alias("n_lines"),
        here(_removed(text, r"\p{Lu}+")).alias("n_upper"),
        here(_removed(text, "!+")).alias("n_exclaim"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``measure(docs)`` with ``failed``: bit b set if the document fails rule b.
    A column of ``docs`` named failed is replaced."""
    measured = measure(docs)
    failed = F.lit(0).cast("long")
    for b, (_, condition) in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failed", failed)


def passes(policy: Policy, failed: str = "failed") -> Column:
    """Whether a ledger row passes the policy."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns.  Every row is judged on
    its own: repeated rows all stay or all go."""
    taken = {m.lower() for m in MEASURES} | {"failed"}
    # columns named like the ledger's are carried along under other names
    away = {c: free_name(docs, "_own_" + c) for c in docs.columns if c.lower() in taken}
    kept = ledger(docs.withColumnsRenamed(away)).where(passes(policy))
    return kept.withColumnsRenamed({m: "_m_" + m for m in [*MEASURES, "failed"]}).withColumnsRenamed(
        {v: k for k, v in away.items()}
    ).select(*docs.columns)


def ablations(rows: DataFrame, policies: list[Policy]) -> DataFrame:
    """For every policy and rule in it: documents kept by the policy, rejected
    by this rule, rejected by this rule alone, and kept without it.

    ``rows`` is a ledger.  Its masks are counted first (at most two to the number
    of rules), the rest is bit arithmetic on those counts.  An empty ledger gives
    zeros.
    """
    counts = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    grid = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p.version).alias("policy"),
                    F.lit(r).alias("rule"),
                    F.lit(p.mask).cast("long").alias("mask"),
                    F.lit(1 << BIT[r]).cast("long").alias("bit"),
                )
                for p in policies
                for r in p.rules
            ]
        )
    ).alias("of")
    inside = F.col("failed").bitwiseAND(F.col("of.mask"))
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    found = (
        counts.select("failed", "n", grid)
        .groupBy("of.policy", "of.rule")
        .agg(
            total(inside == 0).alias("kept"),
            total(inside.bitwiseAND(F.col("of.bit")) != 0).alias("rejected"),
            total(inside == F.col("of.bit")).alias("only_this_rule"),
            total((inside == 0) | (inside == F.col("of.bit"))).alias("kept_without"),
        )
    )
    every = rows.sparkSession.range(1).select(grid).select("of.policy", "of.rule")
    return every.join(found, ["policy", "rule"], "left").na.fill(0)
