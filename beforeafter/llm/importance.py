"""Importance resampling of documents towards a target set of texts.

Features of a text are its words and pairs of neighbouring words, hashed into a
fixed number of buckets.  A bucket gains by how much more often the target texts
use it than the documents do; a document weighs the mean gain of its features, and
a draw without replacement takes the highest of weight plus Gumbel noise that
depends on the doc_id only.

Counting goes by batch concatenation: the texts of a batch are joined with a
separator that no word contains, one pass of a regular expression finds all words
of all texts, a binary search in the texts' offsets tells whose they are, pairs
across two texts are masked out and one bincount adds up the rest.  Hashes come
for all words at once; that of a pair is combined from those of its words.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beforeafter.llm.common import ship_package, stage

# A word has ASCII digits, lower-case letters and any non-ASCII
# code point, all of whose UTF-8 bytes are 0x80 or higher.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
CRC_POLYNOMIAL = 0xEDB88320

BUCKETS = 10_000
MIN_WORDS = 20
#: Bytes of text looked at together.
BATCH_BYTES = 8 << 20
#: Words longer than this are hashed one by one.
LONG_WORD = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(CRC_POLYNOMIAL), c >> 1).astype(np.uint32)
    return c


_TABLE = _crc_table()


class Shift:
    """What ``length`` more bytes do to a CRC of what comes before them: a linear
    map of 32 bits, as four tables of 256."""

    def __init__(self) -> None:
        self.tables: dict[int, np.ndarray] = {}

    def of(self, length: int) -> np.ndarray:
        found = self.tables.get(length)
        if found is None:
            # images of the 32 bits under `length` zero bytes, by squaring
            bits, step, left = np.uint32(1) << np.arange(32, dtype=np.uint32), None, length
            image = bits.copy()
            step = _TABLE[bits & 255] ^ (bits >> 8)
            while left:
                if left & 1:
                    image = self._apply(step, image)
                step = self._apply(step, step)
                left >>= 1
            byte = np.arange(256, dtype=np.uint32)
            found = np.stack([self._apply(image, byte << np.uint32(8 * k)) for k in range(4)])
            self.tables[length] = found
        return found

    @staticmethod
    def _apply(image: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.uint32)
        for b in range(32):
            out ^= np.where(values >> np.uint32(b) & 1, image[b], 0).astype(np.uint32)
        return out


def word_crcs(blob: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every word, all words one byte further at a time."""
    data = np.frombuffer(blob, np.uint8)
    size = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG_WORD) :]
    for k in range(min(int(size.max(initial=0)), LONG_WORD)):
        live = order[: np.searchsorted(-size[order], -k, side="left")]
        out[live] = _TABLE[(out[live] ^ data[starts[live] + k]) & 255] ^ (out[live] >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(blob[starts[i] : ends[i]])
    return out


def pair_crcs(first: np.ndarray, second: np.ndarray, size: np.ndarray, shift: Shift) -> np.ndarray:
    """CRC-32 of "first second" from the two words' own; ``size``: bytes of the second."""
    c = first ^ np.uint32(0xFFFFFFFF)
    c = _TABLE[(c ^ 32) & 255] ^ (c >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)
    out = np.zeros(len(first), np.uint32)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            t, v = shift.of(int(size[part[0]])), c[part]
            out[part] = t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
    return out ^ second


def features(texts: list[bytes], buckets: int, shift: Shift) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text, words per text): the features of all texts of a batch and
    the position of the text that each belongs to."""
    blob = SEPARATOR.join(texts).lower()
    spans = np.fromiter(chain.from_iterable(map(re.Match.span, WORD.finditer(blob))), np.int64)
    starts, ends = spans[::2], spans[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    of = np.searchsorted(offsets, starts, side="right") - 1
    crc = word_crcs(blob, starts, ends)
    inside = np.flatnonzero(of[1:] == of[:-1])  # pairs within one text
    pairs = pair_crcs(crc[inside], crc[inside + 1], (ends - starts)[inside + 1], shift)
    bucket = np.concatenate((crc, pairs)).astype(np.int64) % buckets
    return bucket, np.concatenate((of, of[inside])), np.bincount(of, minlength=len(texts))


def _slices(column) -> list[tuple[int, list[bytes]]]:
    """Texts of an Arrow column as bytes (null: empty), at most about
    ``BATCH_BYTES`` together, with the position of the first."""
    found, held, size, at = [], [], 0, 0
    for k, value in enumerate(column):
        text = value.as_buffer().to_pybytes() if value.is_valid else b""
        if held and size + len(text) > BATCH_BYTES:
            found.append((at, held))
            held, size, at = [], 0, k
        held.append(text)
        size += len(text)
    if held:
        found.append((at, held))
    return found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often the features of all texts (column text) fall into each bucket.

    A task sends one row per bucket at most; the result has ``buckets`` numbers.
    Null and empty texts, and texts without a word, have no features."""
    ship_package(texts.sparkSession)

    def count(batches):
        import pyarrow as pa

        shift, total = Shift(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _slices(batch.column(0)):
                total += np.bincount(features(part, buckets, shift)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each bucket gains, in thousandths: the logarithm of how much more
    often the target uses it, one added to every count."""
    many, few = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log(((t + 1) * many) / ((s + 1) * few))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``docs`` as (doc_id, n_words, n_features, weight): the floored mean gain of
    a document's features, 0 without any."""
    ship_package(docs.sparkSession)
    told = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def score(batches):
        import pyarrow as pa

        gain, shift = told.value, Shift()
        for batch in batches:
            for at, part in _slices(batch.column(1)):
                bucket, of, n_words = features(part, len(gain), shift)
                sums = np.zeros(len(part), np.int64)
                np.add.at(sums, of, gain[bucket])
                n = np.maximum(2 * n_words - 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        pa.array(n_words.astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                        pa.array(np.where(n > 0, sums // np.maximum(n, 1), 0)),
                    ],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int, doc_id: str = "doc_id") -> Column:
    """Gumbel noise in thousandths, the same for a doc_id whenever it is drawn; a
    null doc_id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    seed: int = 7,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of
    ``docs``.

    ``target`` has a column text.  Of the documents with at least ``min_words``
    words the ``percent`` highest scores are drawn, ties to the smaller doc_id (null
    last); rank counts them from 1 and is null for the rest.  Repeated rows are
    drawn each on its own.  Null and empty texts weigh 0 and are never drawn.  No
    documents: no rows; no target texts: every bucket counts as unseen there.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weigh(docs, gain).withColumn("score", F.col("weight") + noise(seed))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return _ranked(spark, scored, F.col("n_words") >= min_words, order, percent)


def _ranked(spark: SparkSession, rows: DataFrame, able: Column, order: list[Column], percent: int) -> DataFrame:
    """``rows`` with rank.  Rows are dealt by ranges of their order (repeated rows
    apart by a number of their own) and written, so that a row never changes its
    range; ranks go on from range to range by the ranges' sizes."""
    own, part, before = "__own", "__part", "__before"
    held = rows.withColumn(own, F.monotonically_increasing_id())
    held = stage(held, "resample-scores")
    dealt = held.where(able).repartitionByRange(*order, F.col(own)).withColumn(part, F.spark_partition_id())
    dealt = stage(dealt, "resample-ranges")
    # one row per range
    sizes = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    ahead = sizes.select(part, "n", F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    limit = int((sizes.agg(F.sum("n")).first()[0] or 0) * percent // 100)
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order, own)) + F.col(before)
    ranked = dealt.join(F.broadcast(ahead.drop("n")), part).withColumn("rank", place.cast("long")).drop(part, before)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= limit, F.col("rank")))
    rest = held.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop(own)
