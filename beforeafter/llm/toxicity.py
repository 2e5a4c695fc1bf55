"""Toxicity scores of text restored by a noisy-channel decoder.

* A character trigram model is counted over the words of all documents.
* Words written with look-alike characters, stretched letters or spaced letters
  become a lattice: each written character offers the letters it may stand for, at
  a channel cost.  Viterbi finds the most probable reading under the trigram model.
  Plain words have one path and are left as they are.
* A logistic regression over character n-grams of the restored words scores the
  text.  Its n-grams are chosen by their counts in all labelled training rows and by
  how many surroundings they have there; the weights are fitted on a bounded sample of those rows.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.llm.common import arrow_rows, broadcast_if_small, ship_package, stage, text_of

# --------------------------------------------------------------------------
# Character model
# --------------------------------------------------------------------------

#: Classes: 0 is the end of a word, 1 any other character, then a-z and Latin-1 letters.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
CLASSES = len(LETTERS) + 2


def class_table() -> np.ndarray:
    """Class of each code point below 65536."""
    table = np.ones(65536, np.int64)
    table[[*range(0x09, 0x0E), 0x20]] = 0
    for k, c in enumerate(LETTERS):
        table[ord(c)] = table[ord(c.upper()) if len(c.upper()) == 1 and ord(c.upper()) < 65536 else ord(c)] = k + 2
    return table


def char_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): counts of character trigrams, word by word, over every text.
    At most ``CLASSES`` cubed rows."""
    ship_package(docs.sparkSession)

    def count(batches):
        import pyarrow as pa

        table, total = class_table(), np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 256):
                text = " ".join(t or "" for t in batch.column(0)[at : at + 256].to_pylist())
                points = np.frombuffer((" " + text + " ").encode("utf-32-le"), np.uint32)
                c = table[np.minimum(points, 65535)]
                # one end between two words, two before the first
                c = np.r_[0, c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]]
                # the second character of a word sees the end before it, not the word before
                before = c[:-2].copy()
                before[c[1:-1] == 0] = 0
                total += np.bincount((before * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    return docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a class after two others: trigram, bigram and single
    counts interpolated with weights that grow with the evidence (Witten-Bell)."""
    c3 = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
    one = c3.sum((0, 1)) + 1.0
    p = np.broadcast_to(one / one.sum(), (CLASSES, CLASSES))
    for c in (c3.sum(0), c3):
        n, kinds = c.sum(-1, keepdims=True), (c > 0).sum(-1, keepdims=True)
        p = (c + kinds * p) / np.maximum(n + kinds, 1) + (n == 0) * p
    return np.log(p)


# --------------------------------------------------------------------------
# Channel and decoder
# --------------------------------------------------------------------------

#: Letters that a written character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
#: Marks that may stand between the letters of a spaced word.
GAPS = " .-_*~'"
#: Channel log probabilities.
SAME, ALIKE, ONCE, TWICE, DOUBLED = 0.0, math.log(0.3), math.log(0.6), math.log(0.4), math.log(0.1)
#: Log probability per letter that a reading must reach to be believed.
LEAST = -3.6
#: Positions of a lattice that are decoded together, runs counted as one position;
#: a longer word is read in pieces of this size that overlap by half.
SLOTS = 48

_EDGE = "\"',.;:?!()[]{}<>«»“”¿¡…"
_LETTER = r"(?:[^\W_]|[@$!|])"
_SPACED = re.compile(rf"(?<!\S){_LETTER}(?:[ .\-_*~']+{_LETTER}){{2,}}(?!\w)")
#: What every spaced word begins with; quick to rule out.
_MAYBE = re.compile(rf"\s{_LETTER}[ .\-_*~']+{_LETTER}[ .\-_*~']+{_LETTER}")
_RUN = re.compile(r"([^\W\d_])\1")
_WORDLIKE = re.compile(r"[^\W\d_]")
_ALIKE = re.compile(r"[0-9@$!|+(*]")
_ODD = re.compile(r"[0-9@$!|+(*]|([^\W\d_])\1")


def slots_of(word: str) -> list[list[tuple[str, float]]] | None:
    """Lattice of a written word: for each position the strings it may stand for
    and their channel log probability.  None if the word has one reading."""
    slots: list[list[tuple[str, float]]] = []
    more = False
    k = 0
    while k < len(word):
        c = word[k]
        run = 1
        while k + run < len(word) and word[k + run] == c:
            run += 1
        if c in LOOKALIKES:
            more = True
            for _ in range(1 if run > 2 else run):
                slots.append([(x, ALIKE) for x in LOOKALIKES[c]])
        elif run > 2:  # a stretched letter: once or twice
            more = True
            slots.append([(c, ONCE), (c + c, TWICE)])
        elif run == 2 and _WORDLIKE.match(c):  # a doubled letter: mostly as written
            more = True
            slots.append([(c + c, SAME), (c, DOUBLED)])
        else:
            slots += [[(c, SAME)]] * run
        k += run
    return slots if more else None


class Decoder:
    """Viterbi over character lattices under the trigram model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        table = class_table()
        self.table = {c: int(table[min(ord(c), 65535)]) for c in LETTERS}
        self.memory: dict[str, list[str]] = {}

    def read(self, slots: list[list[tuple[str, float]]]) -> tuple[str, float]:
        """The most probable reading and its log probability per letter, the end of
        the word included."""
        # state: last two classes -> (log probability, reading)
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        get, model = self.table.get, self.model
        for options in slots:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (p, text) in states.items():
                for string, cost in options:
                    q, x, y = p + cost, a, b
                    for c in string:
                        z = get(c, 1)
                        q += model[x][y][z]
                        x, y = y, z
                    old = after.get((x, y))
                    if old is None or q > old[0] or (q == old[0] and text + string < old[1]):
                        after[(x, y)] = (q, text + string)
            states = after
        best = max(((p + model[a][b][0], text) for (a, b), (p, text) in states.items()), key=lambda s: (s[0], s[1]))
        return best[1], best[0] / (len(best[1]) + 1)

    def words(self, text: str) -> set[str]:
        """Distinct words of a text in lower case, and what the odd ones stand for."""
        text = text.lower()
        ws = set(text.split())
        ws.update(spaced_words(text))
        if len(self.memory) > 200_000:
            self.memory.clear()
        memory = self.memory
        for w in [w for w in ws if _ODD.search(w)]:
            if w not in memory:
                memory[w] = self.readings(w)
            ws.update(memory[w])
        return ws

    def restore(self, word: str) -> str:
        """``word`` (lower case) as it was meant, the first piece of a long one; itself
        if it is plain or no reading is probable enough."""
        return next(iter(self.readings(word)), word)

    def readings(self, word: str) -> list[str]:
        """What ``word`` (lower case) was meant as: nothing if it is plain or no reading
        is probable enough, one reading, or for a word of more than ``SLOTS`` positions
        those of its pieces that are probable enough.  Every word is read to its end,
        in time that grows with its length."""
        core = word.strip(_EDGE.replace("!", "").replace("(", ""))
        if not _WORDLIKE.search(core) or not (_ALIKE.search(core) or _RUN.search(core)):
            return []
        found: dict[int, tuple[str, float]] = {}
        # marks at the end are punctuation or letters: try both
        for form in dict.fromkeys((core, core.strip(_EDGE))):
            slots = slots_of(form)
            if not slots or len(slots) < 3:
                continue
            for at in range(0, max(len(slots) - SLOTS // 2, 1), SLOTS // 2):
                piece = slots[at : at + SLOTS]
                if len(slots) <= SLOTS or any(len(options) > 1 for options in piece):
                    text, p = self.read(piece)
                    if p > found.get(at, ("", LEAST))[1]:
                        found[at] = text, p
        return list(dict.fromkeys(text for text, _ in found.values()))


def spaced_words(text: str) -> list[str]:
    """Words written letter by letter, with any number of marks between, their gaps
    closed; the first letter may be a look-alike."""
    if not _MAYBE.search(" " + text):
        return []
    return ["".join(c for c in m.group() if c not in GAPS) for m in _SPACED.finditer(text)]


# --------------------------------------------------------------------------
# Features and classifier
# --------------------------------------------------------------------------


def word_grams(word: str) -> set[str]:
    """Character n-grams of a word: whole, and of 3 to 6 letters, with the word's
    start marked."""
    core = "^" + word.strip(_EDGE)
    found = {core + "$"}
    for n in (4, 5, 6, 7):
        found.add(core[:n])
    for n in (4, 5):
        found.update(core[k : k + n] for k in range(1, len(core) - n + 1))
    return {g for g in found if len(g) > 3}


@dataclass(frozen=True)
class Model:
    """``chars``: log trigram model; ``weights`` of n-grams; ``bias``."""

    chars: np.ndarray
    weights: dict[str, float]
    bias: float


class Reader:
    """Texts -> n-grams of a fixed list.  ``index`` numbers the n-grams; what a word
    has is remembered, ``most`` words at a time."""

    def __init__(self, chars: np.ndarray, index: dict[str, int], most: int = 600_000):
        import ahocorasick

        self.decoder, self.most = Decoder(chars), most
        self.known: dict[str, frozenset[int]] = {}
        self.finder = ahocorasick.Automaton()
        for g, k in index.items():
            self.finder.add_word(g, k)
        if index:
            self.finder.make_automaton()

    def of_word(self, word: str) -> frozenset[int]:
        """Listed n-grams (see ``word_grams``) of a word as written and as restored."""
        if not len(self.finder):
            return frozenset()
        found = {k for _, k in self.finder.iter(f"^{word.strip(_EDGE)}$")}
        if _ODD.search(word):
            for meant in self.decoder.readings(word):
                found.update(k for _, k in self.finder.iter(f"^{meant.strip(_EDGE)}$"))
        return frozenset(found)

    def read(self, text: str) -> set[int]:
        text = text.lower()
        ws = set(text.split())
        ws.update(spaced_words(text))
        if len(self.known) + len(ws) > self.most:
            self.known.clear()
        known = self.known
        out: set[int] = set()
        for w in ws:
            found = known.get(w)
            if found is None:
                found = known[w] = self.of_word(w)
            if found:
                out |= found
        return out


def held_out(doc_id: str = "doc_id", of: int = 3, part: int = 1) -> Column:
    """Whether a document is kept from training: crc32 of its doc_id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == part, F.lit(False))


def word_counts(rows: DataFrame, chars: np.ndarray, held: int = 300_000) -> DataFrame:
    """(word, toxic, clean): distinct texts with each word, as written and as
    restored, by label.  ``rows`` has text and label; a task sends its counts on
    whenever it holds ``held`` words."""
    ship_package(rows.sparkSession)

    def count(batches):
        import pyarrow as pa

        def sent(n):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(n), pa.string()),
                    pa.array([v[0] for v in n.values()], pa.int64()),
                    pa.array([v[1] for v in n.values()], pa.int64()),
                ],
                names=["word", "toxic", "clean"],
            )

        decoder = Decoder(chars)
        n: dict[str, list[int]] = {}
        for batch in batches:
            for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                column = 0 if label == 1 else 1
                for w in decoder.words(t or ""):
                    n.setdefault(w, [0, 0])[column] += 1
                if len(n) >= held:
                    yield sent(n)
                    n = {}
        yield sent(n)

    counted = rows.select("text", "label").mapInArrow(count, "word string, toxic long, clean long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def gram_counts(words: DataFrame, held: int = 300_000) -> DataFrame:
    """(gram, toxic, clean): how often words with each n-gram stand in texts of
    either label, from the result of ``word_counts``."""

    def count(batches):
        import pyarrow as pa

        def sent(n):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(n), pa.string()),
                    pa.array([v[0] for v in n.values()], pa.int64()),
                    pa.array([v[1] for v in n.values()], pa.int64()),
                ],
                names=["gram", "toxic", "clean"],
            )

        n: dict[str, list[int]] = {}
        for batch in batches:
            for w, toxic, clean in zip(*(c.to_pylist() for c in batch.columns)):
                for g in word_grams(w):
                    v = n.setdefault(g, [0, 0])
                    v[0] += toxic
                    v[1] += clean
                if len(n) >= held:
                    yield sent(n)
                    n = {}
        yield sent(n)

    counted = words.select("word", "toxic", "clean").mapInArrow(count, "gram string, toxic long, clean long")
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_grams(counts: DataFrame, toxic: int, clean: int, chance: float = 0.01, least: int = 8) -> list[str]:
    """Every n-gram that marks toxic texts beyond chance: found at least ``least`` times
    in them, relatively four times as often as in clean ones, and with a log-likelihood
    gain that no n-gram of a corpus without such n-grams reaches but with probability
    ``chance`` (the tail of one test is about exp(-gain), and as many are made as there
    are n-grams).  The rule is the same at every size and keeps all that pass, the
    best first; shorter n-grams win ties, so a stem stands for its words.  Words
    often enough in toxic texts bound the list, not the number of texts."""
    if not toxic or not clean:
        return []
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rate = (a + b) / (toxic + clean)
    part = lambda n, of: F.when(n > 0, n * F.log(n / (of * rate))).otherwise(0.0)
    gain = part(a, toxic) + part(b, clean)
    beyond = math.log(max(counts.count(), 1) / chance)
    rows = (
        counts.where((a >= least) & (a / toxic > 4 * (b + 1) / clean))
        .withColumn("gain", gain)
        .where(F.col("gain") >= beyond)
        .orderBy(F.col("gain").desc(), F.length("gram"), "gram")
    )
    return [r["gram"] for r in rows.select("gram").collect()]


def contexts(rows: DataFrame, chars: np.ndarray, index: dict[str, int]) -> DataFrame:
    """(gram, n, texts): how many different pairs of neighbouring words the words with
    each chosen n-gram have, and in how many texts they stand.  Copies of a text add
    nothing to the first."""

    def count(batches):
        import pyarrow as pa

        reader = Reader(chars, index)
        for batch in batches:
            seen: set[tuple[int, int, int]] = set()
            for t in batch.column(0).to_pylist():
                text = zlib.crc32((t or "").encode())
                ws = ["", *(t or "").lower().split(), ""]
                hit = {w: reader.read(w) for w in set(ws)}
                for k in range(1, len(ws) - 1):
                    if hit[ws[k]]:
                        around = zlib.crc32(f"{ws[k - 1]} {ws[k + 1]}".encode())
                        seen.update((g, around, text) for g in hit[ws[k]])
            columns = [*zip(*seen)] or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                names=["gram", "context", "in_text"],
            )

    found = rows.select("text").mapInArrow(count, "gram int, context long, in_text long")
    return found.groupBy("gram").agg(
        F.countDistinct("context").alias("n"), F.countDistinct("in_text").alias("texts")
    )


def fit_logistic(rows: list[tuple[int, list[int]]], n: int, l2: float = 0.1, steps: int = 800) -> tuple[np.ndarray, float]:
    """Weights (not below zero) and bias over 0/1 features by projected gradient
    steps with momentum; both labels weigh alike."""
    y = np.array([label for label, _ in rows], float)
    flat = np.array([k for _, own in rows for k in own], np.int64)
    at = np.repeat(np.arange(len(rows)), [len(own) for _, own in rows])
    share = max(y.mean(), 1e-9)
    weight = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1e-9)) / len(rows)
    w, b, vw, vb = np.zeros(n), 0.0, np.zeros(n), 0.0
    # step sizes from the curvature bound of each feature
    curve = np.bincount(flat, weights=weight[at] * np.maximum(np.bincount(at, minlength=len(rows))[at], 1), minlength=n) / 4 + l2 / len(rows)
    for _ in range(steps):
        z = np.bincount(at, weights=w[flat], minlength=len(rows)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) * weight
        gw = np.bincount(flat, weights=err[at], minlength=n) + l2 * w / len(rows)
        vw = 0.9 * vw - 0.5 * gw / curve
        vb = 0.9 * vb - 0.5 * err.sum()
        w, b = np.maximum(w + vw, 0.0), b + vb
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, sample: int = 30_000, seed: int = 0) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Characters are counted over every text, n-grams over every labelled row outside
    the held-out part.  Weights are fitted on about ``sample`` of those rows, taken
    by a hash of the text.  Texts that occur under several doc_ids, and rows with
    a null label, count once and not at all.  Without rows of both labels the model
    scores every text alike.
    """
    spark = docs.sparkSession
    with arrow_rows(spark, 1000):
        table = stage(char_counts(docs), "toxic-chars").collect()  # bounded: CLASSES cubed
    counts = np.zeros(CLASSES**3)
    for r in table:
        counts[r["gram"]] = r["n"]
    chars = log_model(counts)
    marked = labels.where(F.col("toxic").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").alias("label"))
    # one row per text, found without moving texts; then the texts themselves, once
    keyed = docs.select("doc_id", "text", F.md5(text_of("text").cast("binary")).alias("same"))
    chosen = keyed.drop("text").join(marked, "doc_id").groupBy("same").agg(
        F.max("label").cast("int").alias("label"), F.min("doc_id").alias("doc_id")
    )
    rows = keyed.join(broadcast_if_small(stage(chosen, "toxic-ids")), ["doc_id", "same"])
    rows = stage(rows.select(F.xxhash64(F.lit(seed), "same").alias("order"), "label", "text"), "toxic-rows")
    n = rows.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")).first()
    toxic = n["toxic"] or 0
    with arrow_rows(spark, 1000):
        words = stage(word_counts(rows, chars), "toxic-words")
    totals = words.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    found = stage(gram_counts(words), "toxic-grams")
    chosen = choose_grams(found, totals["toxic"] or 0, totals["clean"] or 0)
    chosen = _spread(rows.where("label = 1"), chars, chosen)
    if not chosen:
        return Model(chars, {}, math.log((toxic + 0.5) / (n["all"] - toxic + 0.5)) if n["all"] else -3.0)
    index = {g: k for k, g in enumerate(chosen)}
    part = F.pmod("order", F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / n["all"]))
    with arrow_rows(spark, 1000):
        fitted = hits(rows.where(part), chars, index).collect()  # about `sample` rows, a few numbers each
    w, b = fit_logistic([(r["label"], r["hits"]) for r in fitted], len(chosen))
    return Model(chars, {g: float(w[k]) for g, k in index.items() if w[k] > 0}, b)


def _spread(rows: DataFrame, chars: np.ndarray, chosen: list[str], least: int = 8) -> list[str]:
    """The chosen n-grams that stand in at least ``least`` texts and in at least
    ``least`` different surroundings: not words of one text and its copies.  Neither
    minimum rises with the number of texts, so further texts and near copies never
    take an n-gram away."""
    if not chosen:
        return []
    index = {g: k for k, g in enumerate(chosen)}
    with arrow_rows(rows.sparkSession, 1000):
        found = {r["gram"]: r for r in contexts(rows, chars, index).collect()}  # one row per chosen n-gram
    ok = {k for k, r in found.items() if r["texts"] >= least and r["n"] >= least}
    return [g for g, k in index.items() if k in ok]


def hits(rows: DataFrame, chars: np.ndarray, index: dict[str, int]) -> DataFrame:
    """(label, hits): which of the chosen n-grams each text has."""

    def find(batches):
        import pyarrow as pa

        reader = Reader(chars, index)
        for batch in batches:
            got = [sorted(reader.read(t or "")) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(got, pa.list_(pa.int32()))], names=["label", "hits"]
            )

    return rows.select("text", "label").mapInArrow(find, "label int, hits array<int>")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts get the score
    of a text without any n-gram of the model.  Only the text enters the score."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((model.chars, model.weights, model.bias))  # bounded by the model's parameters
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())]
    )

    def run(batches):
        import pyarrow as pa

        chars, weights, bias = shared.value
        names = list(weights)
        index = {g: k for k, g in enumerate(names)}
        w = [weights[g] for g in names]
        reader = Reader(chars, index)
        for batch in batches:
            out = []
            for t in batch.column(1):
                z = bias + math.fsum(w[k] for k in reader.read(t.as_py() or ""))
                out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
