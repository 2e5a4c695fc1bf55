"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Two passes over the training texts count words, then pairs of words.  Tasks
pre-aggregate, pack what they have counted into compressed sorted arrays and send
them to shards; a shard merges its arrays and writes them, sorted, as plain files
into the shared checkpoint folder:

* words: sorted 64-bit hashes and counts; a word's id is its rank;
* pairs: sorted 64-bit keys (id of the first word, id of the second) and counts,
  and for each first word the total and how many pairs were seen once, twice and
  more often; a first word lies in one shard;
* continuations: for each word how many different words it follows.

Workers memory-map these files (from a file system that only Hadoop reads, a local
copy of them) and look up whole batches by binary search, so a worker needs no
more memory than its batch.  The files grow with the number of distinct pairs.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.llm.common import arrow_rows, ship_package, shuffle_parts, stage
from beforeafter.session import scratch_path

#: Ids below the words': begin of a text (never predicted) and end of a text.
BEGIN, END, FIRST = 0, 1, 2
#: Pairs or words a task holds before it sends them on.
HELD = 3_000_000

# --------------------------------------------------------------------------
# Packed arrays and files
# --------------------------------------------------------------------------


def pack(values: np.ndarray, ascending: bool) -> bytes:
    """Unsigned integers, compressed: differences if sorted, byte planes, zstd."""
    import zstandard

    v = values.astype(np.uint64)
    if ascending:
        v = np.diff(v, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(blob: bytes, ascending: bool) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    v = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum(v, dtype=np.uint64) if ascending else v


def small(values: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _local(folder: str) -> str | None:
    """The path of a folder on a shared file system that is mounted, else None."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return folder if "://" not in folder else None


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array whole or not at all: a task that is tried again overwrites."""
    path = _local(folder)
    if path:
        os.makedirs(path, exist_ok=True)
        draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            np.save(f, values)
        os.replace(draft, f"{path}/{name}.npy")
        return
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    with store.open_output_stream(f"{base}/{name}.npy") as out:
        np.save(out, values)


_COPIES: dict[str, str] = {}


def load(folder: str, name: str) -> np.ndarray:
    """Memory-map an array."""
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        path = _COPIES.setdefault(folder, tempfile.mkdtemp(prefix="model-"))
        if not os.path.exists(f"{path}/{name}.npy"):
            with store.open_input_stream(f"{base}/{name}.npy") as f, open(f"{path}/.{name}", "wb") as out:
                shutil.copyfileobj(f, out)
            os.replace(f"{path}/.{name}", f"{path}/{name}.npy")
    return np.load(f"{path}/{name}.npy", mmap_mode="r") if os.path.getsize(f"{path}/{name}.npy") > 128 else np.load(f"{path}/{name}.npy")


# --------------------------------------------------------------------------
# Counting
# --------------------------------------------------------------------------


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of UTF-8 texts, text after text, and the number of words
    of each.  bytes.lower() and bytes.split() know ASCII only."""
    from xxhash import xxh64_intdigest

    parts = [t.lower().split() for t in texts]
    n = np.array([len(p) for p in parts], np.int64)
    every = [w for p in parts for w in p]
    return np.fromiter(map(xxh64_intdigest, every), np.uint64, len(every)), n


def token_ids(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of several texts as one sequence: each text is a BEGIN, its words,
    and an END.  Also the position of each text's first predicted token."""
    size = n + 2
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint64)
    out[begin] = BEGIN
    out[begin + size - 1] = END
    inside = np.ones(len(out), bool)
    inside[begin] = inside[begin + size - 1] = False
    out[inside] = words
    return out, begin + 1


def _batches(batches, column: int, chars: int = 3_000_000):
    """Texts of Arrow batches, a few million bytes at a time, with their offset."""
    import pyarrow as pa

    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        held, size, start = [], 0, 0
        for k in range(len(texts)):
            t = texts[k].as_py() or b""
            held.append(t)
            size += len(t)
            if size >= chars or k == len(texts) - 1:
                yield batch, start, held
                held, size, start = [], 0, k + 1


def _emit(keys: np.ndarray, counts: np.ndarray, shard_of, shards: int):
    """One row per shard with the packed keys (sorted) and counts."""
    import pyarrow as pa

    to = shard_of(keys)
    order = np.argsort(to, kind="stable")  # keys stay sorted inside a shard
    to, keys, counts = to[order], keys[order], counts[order]
    cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
    stop = np.r_[cut[1:], len(to)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(to[cut].astype(np.int32)),
            pa.array([pack(keys[i:j], True) for i, j in zip(cut, stop)], pa.binary()),
            pa.array([pack(counts[i:j], False) for i, j in zip(cut, stop)], pa.binary()),
        ],
        names=["shard", "keys", "counts"],
    )


PACKED = "shard int, keys binary, counts binary"


def _gather(batches) -> tuple[np.ndarray, np.ndarray]:
    """Everything sent to this task's shards, merged as it arrives."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for batch in batches:
        for k, c in zip(batch.column(1), batch.column(2)):
            held.append((unpack(k.as_py(), True), unpack(c.as_py(), False)))
            n += len(held[-1][0])
            if n > max(HELD, len(keys)):
                keys, counts = merged(np.concatenate([keys, *(h[0] for h in held)]), np.concatenate([counts, *(h[1] for h in held)]))
                held, n = [], 0
    return merged(np.concatenate([keys, *(h[0] for h in held)]), np.concatenate([counts, *(h[1] for h in held)]))


def _by_shard(packed: DataFrame, shards: int) -> DataFrame:
    """One task per shard (the shard number is the partition's number)."""
    return packed.repartitionById(shards, F.col("shard"))


@dataclass(frozen=True)
class Model:
    """Where the arrays lie and the figures that all lookups share."""

    folder: str
    shards: int
    bounds: tuple[int, ...]  # id of the first word of each shard, and one past the last
    texts: int  # training texts, the count of END
    tokens: int
    kinds: int  # distinct training tokens, END included
    pairs: int  # distinct pairs
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_kinds: tuple[int, int, int]  # continuation counts of one, two, more


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more from the counts of counts 1 to 4;
    an undefined one falls back to absolute discounting by one half."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and b else 0.5
        out.append(min(max(d, 0.0), float(k)))
    return tuple(out)


def fit(docs: DataFrame, shards: int | None = None) -> Model:
    """Count the model over every text of ``docs`` (column text; null: empty)."""
    spark = docs.sparkSession
    ship_package(spark)
    shards = shards or max(8, shuffle_parts(spark))
    folder = scratch_path(spark, "kneser-ney")
    texts = docs.select("text")
    width = 2**64 // shards + 1

    def count_words(batches):
        h, c = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        seen, many = 0, 0
        held = []
        for _, _, group in _batches(batches, 0):
            words, n = word_hashes(group)
            seen += len(n)
            u, k = np.unique(words, return_counts=True)
            held.append((u, k.astype(np.uint64)))
            many += len(u)
            if many > HELD:
                h, c = merged(np.concatenate([h, *(x[0] for x in held)]), np.concatenate([c, *(x[1] for x in held)]))
                held, many = [], 0
                if len(h) > HELD:
                    yield _emit(h, c, lambda x: x // np.uint64(width), shards)
                    h, c = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        h, c = merged(np.concatenate([h, *(x[0] for x in held)]), np.concatenate([c, *(x[1] for x in held)]))
        yield _emit(h, c, lambda x: x // np.uint64(width), shards)
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays(  # the number of texts, to shard 0
            [pa.array([0], pa.int32()), pa.array([None], pa.binary()), pa.array([seen.to_bytes(8, "little")], pa.binary())],
            names=["shard", "keys", "counts"],
        )

    def write_words(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        shard, n = TaskContext.get().partitionId(), 0

        def words_only():
            nonlocal n
            for b in batches:
                odd = pc.is_null(b.column(1))
                n += sum(int.from_bytes(x.as_py(), "little") for x in b.column(2).filter(odd))
                yield b.filter(pc.invert(odd))

        keys, counts = _gather(words_only())
        save(folder, f"words-{shard}", keys)
        save(folder, f"word-counts-{shard}", small(counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([len(keys)]), pa.array([int(counts.sum())]), pa.array([n])],
            names=["shard", "n", "tokens", "texts"],
        )

    with arrow_rows(spark, 1000):
        rows = stage(
            _by_shard(texts.mapInArrow(count_words, PACKED), shards).mapInArrow(
                write_words, "shard long, n long, tokens long, texts long"
            ),
            "lm-words",
        ).collect()  # one row per shard
    size = {r["shard"]: r["n"] for r in rows}
    bounds = [FIRST]
    for s in range(shards):
        bounds.append(bounds[-1] + size.get(s, 0))
    n_texts = sum(r["texts"] for r in rows)
    tokens = sum(r["tokens"] for r in rows) + n_texts
    ids = bounds[-1]  # BEGIN, END and every word
    bits = max(1, int(ids + 1).bit_length())
    if 2 * bits > 64:
        raise ValueError("more than 2^32 distinct words")
    known = Words(folder, shards, tuple(bounds))
    per = -(-ids // shards)  # ids are hash ranks: a slice of them has its share of frequent words

    def count_pairs(batches):
        k, c = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        held, many = [], 0
        for _, _, group in _batches(batches, 0):
            words, n = word_hashes(group)
            seq, first = token_ids(known.ids(words), n)
            keys = seq[:-1] << np.uint64(bits) | seq[1:] if len(seq) else seq
            if len(first) > 1:
                keys = np.delete(keys, first[1:] - 2)  # no pair across two texts
            u, m = np.unique(keys, return_counts=True)
            held.append((u, m.astype(np.uint64)))
            many += len(u)
            if many > HELD:
                k, c = merged(np.concatenate([k, *(x[0] for x in held)]), np.concatenate([c, *(x[1] for x in held)]))
                held, many = [], 0
                if len(k) > HELD:
                    yield _emit(k, c, lambda x: (x >> np.uint64(bits)) // np.uint64(per), shards)
                    k, c = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        k, c = merged(np.concatenate([k, *(x[0] for x in held)]), np.concatenate([c, *(x[1] for x in held)]))
        yield _emit(k, c, lambda x: (x >> np.uint64(bits)) // np.uint64(per), shards)

    def write_pairs(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        keys, counts = _gather(batches)
        save(folder, f"pairs-{shard}", keys)
        save(folder, f"pair-counts-{shard}", small(counts))
        at = (keys >> np.uint64(bits)).astype(np.int64) - shard * per
        total = np.bincount(at, weights=counts.astype(np.float64), minlength=per) if len(at) else np.zeros(per)
        save(folder, f"context-totals-{shard}", small(total.astype(np.uint64)))
        for k, some in (("1", counts == 1), ("2", counts == 2), ("3", counts > 2)):
            save(folder, f"context-n{k}-{shard}", small(np.bincount(at[some], minlength=per)))
        of = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        # second words, for the continuation counts; the counts of counts ride along
        import pyarrow as pa

        second, follows = np.unique(keys & np.uint64((1 << bits) - 1), return_counts=True)
        yield _emit(second, follows.astype(np.uint64), lambda x: x // np.uint64(per), shards)
        note = np.array([len(keys), *of], np.uint64).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array([None], pa.binary()), pa.array([note], pa.binary())],
            names=["shard", "keys", "counts"],
        )

    def write_follows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        note = np.zeros(5, np.int64)

        def counts_only():
            nonlocal note
            for b in batches:
                odd = pc.is_null(b.column(1))
                for x in b.column(2).filter(odd):
                    note = note + np.frombuffer(x.as_py(), np.uint64).astype(np.int64)
                yield b.filter(pc.invert(odd))

        keys, counts = _gather(counts_only())
        dense = np.zeros(per, np.uint64)
        dense[keys.astype(np.int64) - shard * per] = counts
        save(folder, f"follows-{shard}", small(dense))
        of = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        more = int((counts > 2).sum())
        yield pa.RecordBatch.from_arrays([pa.array([[*note.tolist(), *of, more]], pa.list_(pa.int64()))], names=["note"])

    with arrow_rows(spark, 1000):
        sent = stage(
            _by_shard(texts.mapInArrow(count_pairs, PACKED), shards).mapInArrow(write_pairs, PACKED), "lm-pairs"
        )
        notes = stage(_by_shard(sent, shards).mapInArrow(write_follows, "note array<long>"), "lm-follows").collect()
    s = np.sum([r["note"] for r in notes], axis=0) if notes else np.zeros(10, np.int64)
    return Model(
        folder,
        shards,
        tuple(bounds),
        n_texts,
        tokens,
        ids - FIRST + (1 if n_texts else 0),
        int(s[0]),
        discounts(s[1:5]),
        discounts(s[5:9]),
        (int(s[5]), int(s[6]), int(s[9])),
    )


# --------------------------------------------------------------------------
# Looking up and scoring
# --------------------------------------------------------------------------


def find(array: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each (sorted) value in a sorted array, and whether it is there."""
    if not len(array):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(array, values), len(array) - 1)
    return at, array[at] == values


@dataclass(frozen=True)
class Words:
    folder: str
    shards: int
    bounds: tuple[int, ...]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words; unknown ones get the id after the last."""
        u, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(u), self.bounds[-1], np.uint64)
        cut = np.searchsorted(u // np.uint64(2**64 // self.shards + 1), np.arange(self.shards + 1))
        for s in range(self.shards):
            if cut[s] < cut[s + 1]:
                part = slice(cut[s], cut[s + 1])
                at, hit = find(load(self.folder, f"words-{s}"), u[part])
                out[part] = np.where(hit, at + self.bounds[s], self.bounds[-1])
        return out[back]

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of sorted ids (0 for an unknown word)."""
        out = np.zeros(len(ids), np.int64)
        cut = np.searchsorted(ids, np.array(self.bounds, np.uint64))
        for s in range(self.shards):
            if cut[s] < cut[s + 1]:
                part = slice(cut[s], cut[s + 1])
                out[part] = load(self.folder, f"word-counts-{s}")[(ids[part] - np.uint64(self.bounds[s])).astype(np.int64)]
        return out


def _discounted(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    c = c.astype(np.float64)
    return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)], 0.0)


class Scorer:
    """Probabilities of a fitted model, looked up batch by batch."""

    def __init__(self, model: Model):
        self.m = model
        self.words = Words(model.folder, model.shards, model.bounds)
        self.ids = model.bounds[-1]
        self.bits = max(1, int(self.ids + 1).bit_length())
        self.per = -(-self.ids // model.shards)

    def _dense(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of an array that has an entry per id, for sorted ids."""
        out = np.zeros(len(ids), np.int64)
        cut = np.searchsorted(ids, np.arange(self.m.shards + 1, dtype=np.uint64) * np.uint64(self.per))
        for s in range(self.m.shards):
            if cut[s] < cut[s + 1]:
                part = slice(cut[s], cut[s + 1])
                out[part] = load(self.m.folder, f"{name}-{s}")[(ids[part] - np.uint64(s * self.per)).astype(np.int64)]
        return out

    def _known(self, name: str, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        ok = ids < self.ids
        out[ok] = self._dense(name, ids[ok])
        return out

    def word_probability(self, ids: np.ndarray) -> np.ndarray:
        """Lower order: share of the distinct pairs that end in the word, discounted
        and interpolated with the uniform distribution over all tokens and one more."""
        uniform = 1.0 / (self.m.kinds + 1)
        if not self.m.pairs:
            return np.full(len(ids), uniform)
        d = self.m.word_discounts
        left = sum(x * n for x, n in zip(d, self.m.word_kinds)) / self.m.pairs
        return _discounted(self._known("follows", ids), d) / self.m.pairs + left * uniform

    def probability(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """p(second | first) for arrays of ids."""
        key = first << np.uint64(self.bits) | second
        u, back = np.unique(key, return_inverse=True)
        a, b = u >> np.uint64(self.bits), u & np.uint64((1 << self.bits) - 1)
        count = np.zeros(len(u), np.int64)
        cut = np.searchsorted(a, np.arange(self.m.shards + 1, dtype=np.uint64) * np.uint64(self.per))
        for s in range(self.m.shards):
            if cut[s] < cut[s + 1]:
                part = slice(cut[s], cut[s + 1])
                at, hit = find(load(self.m.folder, f"pairs-{s}"), u[part])
                if hit.any():
                    count[part] = np.where(hit, load(self.m.folder, f"pair-counts-{s}")[at], 0)
        words, place = np.unique(b, return_inverse=True)
        lower = self.word_probability(words)[place]
        total = self._known("context-totals", a).astype(np.float64)
        d = self.m.pair_discounts
        spare = sum(x * self._known(f"context-n{k}", a) for x, k in zip(d, "123"))
        seen = total > 0
        p = lower.copy()
        p[seen] = (_discounted(count[seen], d) + spare[seen] * lower[seen]) / total[seen]
        return p[back]

    def score(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per text: tokens, known tokens, log10 base probability, log10 probability."""
        hashes, n = word_hashes(texts)
        seq, first = token_ids(self.words.ids(hashes), n)
        keep = np.ones(len(seq) - 1, bool)
        keep[first[1:] - 2] = False
        second = seq[1:][keep]
        logs = np.log10(self.probability(seq[:-1][keep], second))
        ids, back = np.unique(second, return_inverse=True)
        c = self.words.counts(ids)
        c[ids == END] = self.m.texts
        base = np.log10((c + 1) / (self.m.tokens + self.m.kinds + 1))[back]
        start = np.cumsum(n + 1) - (n + 1)
        return [
            n + 1,
            np.add.reduceat((c > 0)[back].astype(np.int64), start),
            np.add.reduceat(base, start),
            np.add.reduceat(logs, start),
        ]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score for every row.

    Tokens are lower-cased words and one end.  base_score is the add-one unigram
    log10 probability, score the model's.  Null and empty texts are one end; an
    unknown word has the probability of the uniform part.  Repeated rows are scored
    alike; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(model)
        for batch, start, group in _batches(batches, 1):
            out = scorer.score(group)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(group)), *map(pa.array, out)], names=[f.name for f in schema]
            )

    with arrow_rows(spark, 1000):
        return stage(docs.select("doc_id", "text").mapInArrow(run, schema), "lm-scores")


def held_out(of: int = 7, part: int = 2) -> Column:
    """Whether a document is kept from training: crc32 of its doc_id as text.  A
    row without a doc_id trains."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == part, F.lit(False))


def perplexity(log10_probability: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -log10_probability / n_tokens)


def score_all(docs: DataFrame) -> tuple[DataFrame, Model]:
    """Fit on the documents outside the held-out part, score all of them."""
    model = fit(docs.where(~held_out()))
    return score(docs, model), model


__all__ = ["Model", "Scorer", "SparkSession", "fit", "held_out", "perplexity", "score", "score_all"]
