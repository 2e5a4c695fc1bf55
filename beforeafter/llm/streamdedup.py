"""Exact deduplication as a stateful stream.

Files of documents are read as a stream.  The stream's state is keyed by the
digest of the text, lives on disk (RocksDB, saved to the shared folder with every
micro-batch) and never expires.  For each digest it retains

* ``first``: identifier and content locator (file, row in the file) of the row
  that brought the digest first; it never changes, so later copies are always
  compared with the same content;
* ``keep``: identifier and locator of the row that stays, the largest doc_id;
* ``n``: how many rows had the digest so far.

A digest only proposes equality.  After each run every digest that was hit is
checked on full bytes: the run's texts are grouped by (digest, text), together
with the content that ``first`` locates where it came in an earlier run.  A digest
with more than one text is recorded as collided and its rows are decided by their
texts instead.

A run may end anywhere: the stream goes on from its checkpoint, a replayed
micro-batch writes the same folder again, and batches that were not checked yet
are checked by the next run.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beforeafter.llm.common import free_name, stage, text_of

#: A digest with at least this part of all rows is joined apart: there are at
#: most as many of them, so their list is small however large the corpus is.
HEAVY = 10_000
#: Bytes of files that one micro-batch takes.
BATCH_BYTES = 256 << 30

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # no space set aside per state partition before it is used
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def unchanged(text: Column) -> Column:
    return text


@dataclass(frozen=True)
class Store:
    """Where a corpus keeps its state: a folder that driver and executors share.

    ``normalise`` gives the text that is compared, ``digest`` its digest (binary).
    Both must stay the same for the life of the folder.
    """

    spark: SparkSession
    path: str
    schema: StructType
    normalise: Callable[[Column], Column] = unchanged
    digest: Callable[[Column], Column] = sha256
    batch_bytes: int = BATCH_BYTES

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    def rows(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text, digest, file, row) of documents read from files."""
        text = self.normalise(text_of("text"))
        return docs.select(
            F.col("doc_id").alias("doc_id"),
            text.alias("text"),
            self.digest(text).alias("digest"),
            *_locator(docs, "file", "row"),
        )

    def read(self, files: list[str]) -> DataFrame:
        if not files:
            empty = self.spark.createDataFrame([], self.schema)
            text = self.normalise(text_of("text"))
            return empty.select(
                "doc_id",
                text.alias("text"),
                self.digest(text).alias("digest"),
                F.lit("").alias("file"),
                F.lit(0).cast("long").alias("row"),
            )
        return self.rows(self.spark.read.schema(self.schema).parquet(*[unquote(f) for f in files]))


def ingest(store: Store, path: str) -> None:
    """Take every file below ``path`` (a folder or a single Parquet file) that
    the store has not seen, then check the hits on full bytes.

    Null texts count as empty.  Files without rows and an empty folder change
    nothing.  Columns beyond doc_id and text are ignored.
    """
    spark = store.spark
    source = (
        spark.readStream.schema(store.schema)
        .option("maxBytesPerTrigger", store.batch_bytes)
        .parquet(_as_stream_path(spark, path))
    )
    rows = store.rows(source).select("doc_id", "digest", "file", "row", F.current_timestamp().alias("seen"))
    # a row counts under its digest and under its file: the second tells what a run has read
    none = F.lit(None)
    keyed = rows.withColumn(
        "key",
        F.explode(
            F.array(
                F.struct(F.col("digest").alias("digest"), none.cast("string").alias("path")),
                F.struct(none.cast("binary").alias("digest"), F.col("file").alias("path")),
            )
        ),
    ).select("key.digest", "key.path", "seen", "file", "row", "doc_id")
    state = keyed.groupBy("digest", "path").agg(
        F.min(F.struct("seen", "file", "row", "doc_id")).alias("first"),
        F.max(F.struct("doc_id", "file", "row")).alias("keep"),
        F.count(F.lit(1)).alias("n"),
    )

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{store.path}/changed/{batch}")

    with _conf(spark, _STATE_CONF):
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", store.checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(save)
            .start()
        )
        query.awaitTermination()
    _check_hits(store)


def _check_hits(store: Store) -> None:
    """Full bytes of every digest hit since the last check; collided digests are
    written under the number of the last batch that was looked at."""
    spark = store.spark
    done = max(_numbers(spark, f"{store.path}/collided"), default=-1)
    batches = [b for b in _numbers(spark, f"{store.path}/changed") if b > done]
    if not batches:
        return
    changed = spark.read.parquet(*[f"{store.path}/changed/{b}" for b in batches])
    # names of files, as the driver lists them to plan a scan
    files = [r.path for r in changed.where("path is not null").select("path").distinct().collect()]
    new = store.read(files)
    earlier = (
        changed.where("digest is not null and n > 1")
        .groupBy("digest")
        .agg(F.min("first").alias("first"))
        .select("digest", "first.file", "first.row")
        .join(changed.where("path is not null").select(F.col("path").alias("file")).distinct(), "file", "left_anti")
    )
    earlier = stage(earlier, "dedup-earlier")
    held = [r.file for r in earlier.select("file").distinct().collect()]
    content = store.read(held).drop("digest", "doc_id").join(earlier, ["file", "row"])
    texts = new.select("digest", "text").unionByName(content.select("digest", "text"))
    # copies collapse before the shuffle, whatever their number
    different = texts.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").count()
    different.where("count > 1").select("digest").write.mode("overwrite").parquet(f"{store.path}/collided/{batches[-1]}")


def retained(store: Store) -> DataFrame:
    """The keyed state as it stands: (digest, first, keep, n)."""
    state = store.spark.read.format("statestore").load(store.checkpoint)
    return state.where("key.digest is not null").select(
        "key.digest",
        F.col("value.min").alias("first"),
        F.col("value.max").alias("keep"),
        F.col("value.count").alias("n"),
    )


def collided(store: Store) -> DataFrame:
    """Digests that stand for more than one text."""
    found = _numbers(store.spark, f"{store.path}/collided")
    if not found:
        return store.spark.createDataFrame([], "digest binary")
    return store.spark.read.parquet(*[f"{store.path}/collided/{b}" for b in found]).distinct()


def verdicts(store: Store) -> DataFrame:
    """(doc_id, digest, file, row, keep_id, group_size, kept) for every row taken
    so far.

    Of rows with equal texts exactly one has ``kept``: the one with the largest
    doc_id (null below every number), of repeated rows with that doc_id the one in
    the last file and row.  ``keep_id`` is its doc_id.  Null and empty texts are
    equal.  No rows: no verdicts.
    """
    spark = store.spark
    if not _numbers(spark, f"{store.path}/changed"):
        return _verdict(store.read([]), F.lit(None).cast("struct<doc_id:long,file:string,row:long>"), F.lit(0))
    changed = spark.read.parquet(*[f"{store.path}/changed/{b}" for b in _numbers(spark, f"{store.path}/changed")])
    rows = store.read([r.path for r in changed.where("path is not null").select("path").distinct().collect()])
    with _conf(spark, _STATE_CONF):
        groups = stage(retained(store).select("digest", "keep", "n"), "dedup-groups")
    clash = collided(store)
    sure = stage(rows.drop("text").join(clash, "digest", "left_anti"), "dedup-rows")
    total = groups.agg(F.sum("n")).first()[0] or 0
    # at most HEAVY digests can have that many rows each
    heavy = F.broadcast(groups.where(F.col("n") * HEAVY >= total))
    light = groups.where(F.col("n") * HEAVY < total)
    decided = [
        _verdict(sure.join(heavy, "digest"), F.col("keep"), F.col("n")),
        _verdict(sure.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").join(light, "digest"), F.col("keep"), F.col("n")),
    ]
    # digests that stand for several texts: by their texts
    unsure = rows.join(clash, "digest", "left_semi")
    by_text = unsure.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    decided.append(_verdict(unsure.join(by_text, ["digest", "text"]), F.col("keep"), F.col("n")))
    return decided[0].unionByName(decided[1]).unionByName(decided[2])


def kept_documents(store: Store, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (read from files that the store has taken) that stay,
    with all their columns."""
    file, row = free_name(docs, "_file"), free_name(docs, "_row")
    stay = verdicts(store).where("kept").select(F.col("file").alias(file), F.col("row").alias(row))
    return docs.select("*", *_locator(docs, file, row)).join(stay, [file, row], "left_semi").select(*docs.columns)


def _locator(docs: DataFrame, file: str, row: str) -> list[Column]:
    place = docs.metadataColumn("_metadata")
    return [place["file_path"].alias(file), place["row_index"].alias(row)]


def _verdict(rows: DataFrame, keep: Column, n: Column) -> DataFrame:
    return rows.select(
        "doc_id",
        "digest",
        "file",
        "row",
        keep["doc_id"].alias("keep_id"),
        n.cast("long").alias("group_size"),
        ((keep["file"] == F.col("file")) & (keep["row"] == F.col("row"))).alias("kept"),
    )


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hadoop(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _as_stream_path(spark: SparkSession, path: str) -> str:
    """Streams read folders; a single file is named by a pattern that only it fits."""
    place, fs = _hadoop(spark, path)
    if not fs.getFileStatus(place).isFile():
        return path
    return f"{place.getParent().toString()}/{{{place.getName()}}}"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbered subfolders that were written to the end, in order."""
    place, fs = _hadoop(spark, folder)
    if not fs.exists(place):
        return []
    whole = [s.getPath() for s in fs.listStatus(place) if fs.exists(_hadoop(spark, f"{s.getPath().toString()}/_SUCCESS")[0])]
    return sorted(int(p.getName()) for p in whole)
