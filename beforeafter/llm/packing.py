"""Best-fit packing of token pieces into sequences by bin completion.

Documents are tokenized, cut into pieces of at most ``capacity`` tokens, and
the pieces placed into as few sequences as possible.  A packing only depends on
how many pieces there are of each length, so the search runs on the length
histogram, which has at most ``capacity`` rows however large the corpus is.  The
search returns *patterns* (a filling of one sequence and how often it is used);
Spark then ranks the pieces of each length and maps the ranks to places.

The search is branch and bound over bin completions: take the longest piece
left, enumerate the undominated fillings of the rest of its sequence, try them
with the least waste first, and cut a branch once its waste alone needs as many
sequences as the best solution known.  Best-fit decreasing gives the first
solution; the total length gives the lower bound at which the search ends.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.llm.common import arrow_rows, ship_package, shuffle_parts, stage

Pattern = tuple[tuple[int, ...], int]

# --------------------------------------------------------------------------
# Search over the length histogram (at most `capacity` sizes)
# --------------------------------------------------------------------------


def lower_bound(hist: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: total length, and pieces over half of it."""
    total = sum(s * n for s, n in hist.items())
    return max(-(-total // capacity), sum(n for s, n in hist.items() if 2 * s > capacity))


def best_fit_decreasing(hist: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, on whole groups of equal open sequences."""
    groups: dict[int, dict[tuple[int, ...], int]] = {}
    for s in sorted(hist, reverse=True):
        n = hist[s]
        while n:
            room = next((r for r in range(s, capacity + 1) if groups.get(r)), None)
            if room is None:
                # every further piece opens a sequence until one with room exists
                fit = capacity // s
                full, rest = divmod(n, fit)
                for times, per in ((full, fit), (1, rest)):
                    if times and per:
                        g = groups.setdefault(capacity - per * s, {})
                        g[(s,) * per] = g.get((s,) * per, 0) + times
                n = 0
                continue
            fill, have = next(iter(groups[room].items()))
            per = min(room // s, n)
            use = min(have, n // per)
            if have == use:
                del groups[room][fill]
            else:
                groups[room][fill] = have - use
            to = groups.setdefault(room - per * s, {})
            key = fill + (s,) * per
            to[key] = to.get(key, 0) + use
            n -= use * per
    return [(fill, n) for g in groups.values() for fill, n in g.items()]


def _fits_in(items: tuple[int, ...], rooms: list[int]) -> bool:
    """Whether ``items`` can be placed into ``rooms``."""
    if not items:
        return True
    head, tail = items[0], items[1:]
    for k in range(len(rooms)):
        if rooms[k] >= head and rooms[k] not in rooms[:k]:
            if _fits_in(tail, rooms[:k] + [rooms[k] - head] + rooms[k + 1 :]):
                return True
    return False


def undominated(fillings: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Drop a filling whose pieces can be placed inside those of another one
    (Martello and Toth): exchanging the two never costs a sequence.  Fillings of
    more than 24 pieces are kept untested."""
    kept: list[tuple[int, ...]] = []
    for f in sorted(set(fillings), key=lambda f: (-sum(f), len(f), tuple(-x for x in f))):
        if len(f) > 24 or not any(_fits_in(f, list(k)) for k in kept):
            kept.append(f)
    return kept


def completions(
    hist: dict[int, int], sizes: list[int], room: int, most_waste: int, width: int, nodes: int
) -> tuple[list[tuple[int, ...]], int]:
    """Undominated fillings of ``room`` with at most ``most_waste`` left over,
    least waste first, and the number of steps taken.  ``sizes`` are the sizes on
    hand, longest first.  At most ``width`` maximal fillings are kept from
    ``nodes`` steps."""
    if room in hist and hist[room]:
        return [(room,)], 1  # one piece that fills the room dominates everything
    found: list[tuple[int, ...]] = []
    seen = 0
    perfect = False

    def go(start: int, left: int, fill: tuple[int, ...]) -> None:
        nonlocal seen, perfect
        for i in range(max(start, bisect_left(sizes, -left, key=int.__neg__)), len(sizes)):
            s = sizes[i]
            for k in range(min(left // s, hist[s]), 0, -1):
                seen += 1
                if seen > nodes or len(found) >= width or perfect:
                    return
                go(i + 1, left - k * s, fill + (s,) * k)
        if left <= most_waste:
            found.append(fill)
            perfect = perfect or left == 0

    go(0, room, ())
    return undominated(found), seen + 1


def bin_completion(
    hist: dict[int, int],
    capacity: int,
    max_steps: int = 400_000,
    width: int = 12,
    fill_steps: int = 1500,
    dives: int = 2,
    finish_every: int = 64,
) -> list[Pattern]:
    """Patterns ``(sizes, times)`` that place every piece of ``hist``.

    ``width`` and ``fill_steps`` bound the fillings looked at in one branch, a step is
    one filling looked at.  A dive to a whole solution has about one node for each
    length, so the search ends after ``max_steps`` or the steps of ``dives`` whole
    dives, whichever is more; neither depends on the number of pieces.  What is left
    is also finished by best fit after every ``finish_every`` nodes and at the end, and
    taken if that is better.  The best solution so far stands, so the result is always
    whole and never worse than best-fit decreasing.
    """
    hist = {s: n for s, n in hist.items() if n > 0}
    if not hist:
        return []
    if max(hist) > capacity or min(hist) < 1:
        raise ValueError("piece lengths must be between 1 and the capacity")
    low = lower_bound(hist, capacity)
    best = best_fit_decreasing(hist, capacity)
    best_n = sum(n for _, n in best)
    total = sum(s * n for s, n in hist.items())
    max_steps = max(max_steps, dives * len(hist) * (fill_steps + 1))
    steps = nodes = 0
    # depth-first, least waste first; a node is (histogram before its pattern, patterns, bins, waste)
    stack: list[tuple[dict[int, int], tuple, int, int]] = [(hist, (), 0, 0)]
    while stack and best_n > low:
        before, chosen, bins, waste = stack.pop()
        spare = (best_n - 1) * capacity - total - waste
        if spare < 0:
            continue  # the waste so far already costs as many sequences
        left = before
        if chosen:
            pattern, times = chosen[1]
            left = dict(before)
            for s in pattern:
                left[s] -= times
                if not left[s]:
                    del left[s]
        nodes += 1
        if not left or steps >= max_steps or nodes % finish_every == 0:
            tail = best_fit_decreasing(left, capacity)
            if (n := bins + sum(t for _, t in tail)) < best_n:
                best, best_n = [*_unlink(chosen), *tail], n
                spare = (best_n - 1) * capacity - total - waste
            if steps >= max_steps:
                break
            if not left or spare < 0:
                continue
        sizes = sorted(left, reverse=True)
        top = sizes[0]
        rest = dict(left)
        rest[top] -= 1
        options, seen = completions(
            rest, [s for s in sizes if rest[s]], capacity - top, spare, width, fill_steps
        )
        steps += seen
        for fill in reversed(options):
            pattern = (top, *fill)
            times = min(left[s] // pattern.count(s) for s in set(pattern))
            gap = capacity - sum(pattern)
            if gap:
                times = max(1, min(times, spare // gap))
            stack.append((left, (chosen, (pattern, times)), bins + times, waste + times * gap))
    return best


def _unlink(chosen: tuple) -> Iterator[Pattern]:
    while chosen:
        chosen, last = chosen
        yield last


# --------------------------------------------------------------------------
# Tokenizing (Arrow batches; Spark partitions the work)
# --------------------------------------------------------------------------

_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def byte_letters() -> str:
    """The printable stand-in of each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the other bytes for the code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(other)) for b in range(256))


class WordEncoder:
    """Ids of a text as little-endian 32-bit bytes, word by word.

    The word BPE drops white space before it looks for merges, so the words of a
    text are encoded independently and their ids can be kept in a dictionary.
    ``max_words`` bounds the dictionary; a full one is emptied before the next text.
    """

    # Composed Latin letters are one pretoken as a run, and so is a
    # run of these marks, whatever stands next to them.  Letters whose lower case
    # is more than one code point are left out.
    _PLAIN = re.compile(
        "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([.,!?;:|]*)\\Z"
    )

    def __init__(self, path: str, max_words: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.letters = str.maketrans({b: c for b, c in enumerate(byte_letters())})
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.max_words = max_words
        self.known: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    @classmethod
    def shared(cls, path: str, max_words: int = 700_000) -> WordEncoder:
        key = (path, max_words)
        if key not in _ENCODERS:
            _ENCODERS[key] = cls(path, max_words)
        return _ENCODERS[key]

    def _part(self, part: str) -> bytes:
        """One lower-case pretoken: straight to the merges."""
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        table = self.id_bytes
        return b"".join([table[t.id] for t in self.merges.tokenize(part)])

    def word(self, word: bytes) -> bytes:
        """Ids of one word."""
        text = word.decode()
        m = self._PLAIN.match(text)
        if m is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return b"".join([self.id_bytes[i] for i in ids])
        end = m[2]
        if not end:
            return self._part(m[1].lower())
        if end not in self.marks:
            if len(self.marks) >= 1000:
                self.marks.clear()
            self.marks[end] = self._part(end)
        return self._part(m[1].lower()) + self.marks[end]

    def encode(self, text: bytes) -> bytes:
        """``text`` in UTF-8.  bytes.lower() and bytes.split() know ASCII only; a
        text that may hold a special token keeps its case until it is encoded."""
        ws = (text if b"<|" in text else text.lower()).split()
        known = self.known
        got = list(map(known.get, ws))
        if None in got:
            if len(known) > self.max_words:
                known.clear()
            for k, ids in enumerate(got):
                if ids is None:
                    w = ws[k]
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = self.word(w)
                    got[k] = ids
        return b"".join(got)

    def encode_batch(self, texts: list[bytes]) -> list[bytes]:
        return [self.encode(t) for t in texts]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, with
    ``keep_ids``, the ids as little-endian 32-bit bytes.

    A document is its ids followed by ``end_id``.  Null and empty texts are one
    piece that holds only the end; a repeated row is a document of its own; other
    columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    key = docs.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", key),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = end_id.to_bytes(4, "little")
    step = 4 * capacity
    at_once = 4_000_000

    def cut(batches):
        import pyarrow as pa

        encoder = WordEncoder.shared(tokenizer_path)
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1).cast(pa.binary())
            start = 0
            while start < len(ids):  # a few million bytes at a time
                group, size = [], 0
                while start + len(group) < len(ids) and (not group or size < at_once):
                    t = texts[start + len(group)].as_py() or b""
                    group.append(t)
                    size += len(t)
                out: list[list] = [[], [], [], [], [], []]
                for k, blob in enumerate(encoder.encode_batch(group)):
                    blob += end
                    for p, at in enumerate(range(0, len(blob), step)):
                        part = blob[at : at + step]
                        out[0].append(start + k)
                        out[1].append(p)
                        out[2].append(at // 4)
                        out[3].append(len(part) // 4)
                        out[4].append(zlib.crc32(part))
                        if keep_ids:
                            out[5].append(part)
                arrays = [ids.take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32())]
                arrays += [pa.array(c, pa.int64()) for c in out[2:5]]
                if keep_ids:
                    arrays.append(pa.array(out[5], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])
                start += len(group)

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


# --------------------------------------------------------------------------
# Placing
# --------------------------------------------------------------------------


def _plan(spark, patterns: list[Pattern]) -> DataFrame:
    """Rows (length, from_rank, to_rank, per, first, base): the pieces of that
    length with a rank in the range fill, ``per`` at a time, the sequences from
    ``first`` on, at offset ``base``."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for fill, times in patterns:
        at = 0
        for s in sorted(set(fill), reverse=True):
            per = fill.count(s)
            begin = used.get(s, 0)
            used[s] = begin + per * times
            rows.append((s, begin, used[s], per, first, at))
            at += per * s
        first += times
    return spark.createDataFrame(
        rows or [], "length long, from_rank long, to_rank long, per long, first long, base long"
    )


def pack_pieces(pieces: DataFrame, capacity: int = 2048, **search) -> DataFrame:
    """``pieces`` (needs doc_id, piece, start, length) with sequence_id and offset.

    Sequences are gapless from offset 0 and hold at most ``capacity`` tokens;
    which piece of equal length goes where follows doc_id, piece, start.  Pieces of
    one length are ranked in salted groups, so a length that a third of all
    pieces share is not sorted in one task.  ``pieces`` is read three times:
    pass a staged table.  No rows in, no rows out.
    """
    spark = pieces.sparkSession
    salts = max(64, shuffle_parts(spark))
    counted = stage(
        pieces.groupBy("length", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).alias("_salt")).agg(
            F.count(F.lit(1)).alias("_n")
        ),
        "pack-counts",
    )  # at most capacity x salts rows
    # bounded: one row for each length from 1 to `capacity`
    hist = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = _plan(spark, bin_completion(hist, capacity, **search))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start")
    ranked = (
        pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
        .withColumn("_k", F.row_number().over(order))
        .join(F.broadcast(starts), ["length", "_salt"])
        .withColumn("_rank", F.col("_from") + F.col("_k") - 1)
    )
    # at most one plan row per pattern and size in it: bounded by the capacity, not by the data
    placed = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("from_rank"))
        & (F.col("_rank") < F.col("to_rank")),
    )
    nth = F.col("_rank") - F.col("from_rank")
    return placed.select(
        *pieces.columns,
        (F.col("first") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Tokenize, cut and pack ``docs`` (doc_id, text): see ``token_pieces`` and
    ``pack_pieces``.  The pieces are staged once; texts are read once."""
    with arrow_rows(docs.sparkSession, 1000):
        pieces = stage(token_pieces(docs, tokenizer_path, capacity, end_id, keep_ids), "pack-pieces")
    return pack_pieces(pieces, capacity)
