"""Line deduplication over levelled sorted runs of line hashes.

A *run* is a table of (line hash, documents, largest doc_id), bucketed and
sorted by the hash, so that joining two runs moves no rows.  Documents arrive in
batches, those with the largest doc_ids first.  The hashes of a batch are
merge-anti-joined with every run: a line that a run already holds as *settled*
(enough documents, and a larger doc_id to keep it) needs no further counting, so
frequent lines stop being written early.  What is left becomes a run of its own.
Whenever a level has ``fanout`` runs they are merged into one of the next level.
The sum over the runs then says which lines are repeated, and where they stay.

DataFrame operations only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.llm.common import SPACE_CHARS, ascii_lower, free_name, shuffle_parts, stage, text_of
from beforeafter.session import scratch_path

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """What makes two lines equal: ASCII white space stripped at both ends, A-Z
    lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def split_lines(text: Column) -> Column:
    return F.split(text_of(text), "\n", -1)


def line_rows(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points: doc_id,
    row (hash of the text, as doc_ids may repeat or be null), pos, and the key's
    128-bit hash."""
    lines = docs.select(
        "doc_id", F.xxhash64(text_of("text")).alias("row"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    keyed = lines.withColumn("line", F.btrim("line", F.lit(SPACE_CHARS))).where(F.char_length("line") >= min_chars)
    keyed = keyed.withColumn("line", ascii_lower(F.col("line")))
    return keyed.select(
        "doc_id", "row", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2")
    )


@dataclass(frozen=True)
class Run:
    """One sorted run: ``table`` knows its buckets, ``path`` holds its files."""

    table: DataFrame
    path: str


class LineRuns:
    """Levelled sorted runs.  ``add`` takes the counts of one batch (h1, h2,
    n_docs, keep_id); documents must not be counted in two batches."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4, buckets: int | None = None):
        self.spark = spark
        self.min_docs = min_docs
        self.fanout = fanout
        self.buckets = buckets or shuffle_parts(spark)
        self.levels: list[list[Run]] = []

    def _write(self, rows: DataFrame) -> Run:
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        (
            rows.repartition(self.buckets, "h1")
            .write.format("parquet")
            .bucketBy(self.buckets, "h1")
            .sortBy(*HASH)
            .option("path", path)
            .saveAsTable(name)
        )
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name; the files stay
        return Run(run, path)

    def add(self, counts: DataFrame) -> None:
        new = counts
        for run in self.runs():
            settled = run.table.where(F.col("n_docs") >= self.min_docs).select(
                *HASH, F.col("keep_id").alias("kept_in")
            )
            # a batch row without any doc_id (null) adds nothing to a settled line either
            no_more = F.coalesce(new.keep_id <= settled.kept_in, new.keep_id.isNull())
            new = new.join(settled, (new.h1 == settled.h1) & (new.h2 == settled.h2) & no_more, "left_anti")
        self._put(0, self._write(new.select(*HASH, "n_docs", "keep_id")))

    def _put(self, level: int, run: Run) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merge(self.levels[level]))
            self.levels[level] = []
            self._put(level + 1, merged)

    def runs(self) -> list[Run]:
        return [run for level in reversed(self.levels) for run in level]

    def repeated(self) -> DataFrame:
        """(h1, h2, keep_id) of the lines found in at least ``min_docs``
        documents; keep_id is the largest doc_id that holds the line."""
        return self._merge(self.runs()).where(F.col("n_docs") >= self.min_docs).select(*HASH, "keep_id")

    def _merge(self, runs: list[Run]) -> DataFrame:
        """Runs summed by line, read as plain files: Spark 4.1 takes a union of
        bucketed scans for partitioned by the buckets even where it reads them
        without, and then leaves a line of two runs in two rows."""
        return (
            self.spark.read.schema(runs[0].table.schema)
            .parquet(*[r.path for r in runs])
            .groupBy(*HASH)
            .agg(F.sum("n_docs").alias("n_docs"), F.max("keep_id").alias("keep_id"))
        )


def repeated_lines(lines: DataFrame, min_docs: int = 5, batches: int = 4, fanout: int = 4) -> DataFrame:
    """The repeated lines among ``lines`` (a staged result of ``line_rows``),
    found batch by batch from the largest doc_ids down."""
    spark = lines.sparkSession
    at = [k / batches for k in range(1, batches)]
    cuts = sorted(set(lines.approxQuantile("doc_id", at, 0.01))) if at else []
    batch = F.lit(0)
    for c in cuts:  # 0 holds the largest doc_ids
        batch = batch + F.when(F.col("doc_id") < F.lit(c), 1).otherwise(0)
    holders = (
        lines.withColumn("batch", F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(batch))
        .groupBy("batch", *HASH, "doc_id", F.when(F.col("doc_id").isNull(), F.col("row")).alias("row"))
        .agg(F.lit(1).alias("one"))
    )
    counts = stage(
        holders.groupBy(*HASH, "batch").agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("keep_id")),
        "line-counts",
        by=["batch"],
    )
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(len(cuts) + 1):
        runs.add(counts.where(F.col("batch") == b).drop("batch"))
    return runs.repeated()


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 4,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with its text rewritten and two more columns, named by ``counts``:
    the lines before, and those dropped.

    A line whose key has at least ``min_chars`` code points and is found in at
    least ``min_docs`` documents is dropped everywhere but in the largest doc_id
    that holds it, where all its occurrences stay.  The other lines stay in order,
    joined by newlines; a text that loses all lines becomes empty.  Null and empty
    texts are one empty line (text ``""``).  Rows with the same doc_id count as one
    document, and the line stays in all of those with the largest doc_id; a row
    without doc_id is a document of its own and never the one that keeps a line.
    Columns of ``docs`` other than text pass through; one named like a count is
    replaced.
    """
    lines = stage(line_rows(docs, min_chars), "lines")
    repeated = stage(repeated_lines(lines, min_docs, batches, fanout), "line-repeated")
    drop = (
        lines.join(repeated, HASH)
        .where(~F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)))
        .groupBy("doc_id", "row")
        .agg(F.collect_set("pos").alias("drop"))  # no longer than the document
    )
    drop = stage(drop, "line-drops")
    drop = drop.select(*[F.col(c).alias(free_name(docs, f"_drop_{c}")) for c in drop.columns])
    id_, row, gone = (F.col(c) for c in drop.columns)
    same = F.col("doc_id").eqNullSafe(id_) & (F.xxhash64(text_of("text")) == row)
    parts = split_lines(F.col("text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    own = [c for c in docs.columns if c.lower() not in counts]
    # the list of drops grows with the corpus: never sent to every task
    joined = docs.join(drop.hint("merge"), same, "left")
    kept = F.when(gone.isNull(), text_of("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    )
    return joined.select(
        *[kept.alias("text") if c == "text" else F.col(c) for c in own],
        F.size(parts).cast("long").alias(counts[0]),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(counts[1]),
    )
