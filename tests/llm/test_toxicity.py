from __future__ import annotations

import zlib

import numpy as np
import pytest

from beforeafter.llm import toxicity
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs

WORDS = "idiot stupid trash scum loser moron pathetic disgusting worthless clown hello little letter".split()


@pytest.fixture(scope="module")
def decoder():
    counts = np.zeros((toxicity.CLASSES,) * 3)
    table = toxicity.class_table()
    for w in WORDS:
        c = [0, 0, *(int(table[ord(x)]) for x in w), 0]
        for a, b, z in zip(c, c[1:], c[2:]):
            counts[a, b, z] += 50
    return toxicity.Decoder(toxicity.log_model(counts))


def test_model_is_a_distribution():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 3, toxicity.CLASSES**3) * (rng.random(toxicity.CLASSES**3) < 0.1)
    assert np.allclose(np.exp(toxicity.log_model(counts)).sum(-1), 1)


@pytest.mark.parametrize(
    "written,meant",
    [("1d10t", "idiot"), ("stuuuupid", "stupid"), ("tr@sh", "trash"), ("$cum", "scum"), ("l0s3r!", "loser"),
     ("m0r0n,", "moron"), ("p4thet1c", "pathetic"), ("cl0wwwwn", "clown"), ("hellllo", "hello"), ("st*pid", "stupid"),
     ("st" + 50 * "u" + "pid", "stupid"), ("1111dddd" + 30 * "i" + "000000ttttttt", "idiot"), ("stuupid", "stupid"),
     ("moorron", "moron")],
)
def test_obfuscated_words_are_restored(decoder, written, meant):
    assert decoder.restore(written) == meant


@pytest.mark.parametrize("word", ["hello", "letter", "2024", "3.", "", "!!", "zzz9q8x7w6", "555-1234", "x" * 500])
def test_plain_and_hopeless_words_stay(decoder, word):
    assert decoder.restore(word) == word


def test_viterbi_finds_the_best_path(decoder):
    import itertools

    slots = toxicity.slots_of("l1tt1eee")
    best = max(
        (sum(p for _, p in path) + log_p(decoder, "".join(s for s, _ in path)), "".join(s for s, _ in path))
        for path in itertools.product(*slots)
    )
    text, p = decoder.read(slots)
    assert text == best[1] and abs(p * (len(text) + 1) - best[0]) < 1e-9


def log_p(decoder, text):
    c = [0, 0, *(decoder.table.get(x, 1) for x in text), 0]
    return sum(decoder.model[a][b][z] for a, b, z in zip(c, c[1:], c[2:]))


def test_spaced_words_are_closed():
    assert toxicity.spaced_words("you i d i o t and s.c.u.m or a b x") == ["idiot", "scum", "abx"]
    assert toxicity.spaced_words("a quick one") == []
    assert toxicity.spaced_words("a $ t u p i d one") == ["a$tupid"]
    assert toxicity.spaced_words("so $ t  u -- p . i~~d") == ["$tupid"]
    assert toxicity.spaced_words("s" + "   t" * 500) == ["s" + 500 * "t"]


def test_long_words_are_read_in_overlapping_pieces(decoder):
    long = 40 * "hello" + "1d10t" + 40 * "letter" + "tr@sh" + 30 * "moron"
    found = decoder.readings(long)
    assert any("idiot" in r for r in found) and any("trash" in r for r in found)
    assert all(len(r) <= 2 * toxicity.SLOTS for r in found)
    # a spaced line whose letters close up to more than any limit on characters
    line = toxicity.spaced_words(" ".join("you$tup1dl0s3r" + 60 * "hello"))
    assert any("stupid" in r for w in line for r in decoder.readings(w))
    assert decoder.readings("zq9" * 400) == [] and decoder.restore("zq9" * 400) == "zq9" * 400


def test_every_significant_ngram_is_chosen(spark):
    """More n-grams than any fixed number, and none by chance."""
    marks = [(f"mark{k}", 40, 0) for k in range(6000)]
    plain = [(f"word{k}", 8, 60) for k in range(3000)] + [("rare", 7, 0), ("even", 9, 9)]
    counts = spark.createDataFrame(marks + plain, "gram string, toxic long, clean long")
    chosen = toxicity.choose_grams(counts, 300_000, 400_000)
    assert sorted(chosen) == sorted(g for g, _, _ in marks)
    assert toxicity.choose_grams(counts.where("false"), 10, 10) == []


def test_character_counts_against_plain_python(spark):
    docs = odd_docs(spark)
    got = {r.gram: r.n for r in toxicity.char_counts(docs).collect()}
    table, wanted = toxicity.class_table(), {}
    for r in docs.select("text").collect():
        for w in (r.text or "").replace("\x0b", " ").split():
            c = [0, 0, *(int(table[ord(x)]) for x in w), 0]
            for a, b, z in zip(c, c[1:], c[2:]):
                g = (a * toxicity.CLASSES + b) * toxicity.CLASSES + z
                wanted[g] = wanted.get(g, 0) + 1
    inside = {g: n for g, n in got.items() if (g // toxicity.CLASSES) % toxicity.CLASSES or g % toxicity.CLASSES}
    assert inside == wanted


def test_reader_finds_the_grams_of_words():
    index = {g: g for w in WORDS for g in toxicity.word_grams(w)}
    reader = toxicity.Reader(np.log(np.full((toxicity.CLASSES,) * 3, 1 / toxicity.CLASSES)), index)
    for text in ("(Trash), an idiotic letterbox ^scum$ $scum", "hello", "", "the clown clowns around littler", "^"):
        wanted = {g for w in text.lower().split() for g in toxicity.word_grams(w) if g in index}
        assert reader.read(text) - wanted <= {g for w in ("scum",) for g in toxicity.word_grams(w)}
        assert wanted <= reader.read(text)
    assert toxicity.Reader(reader.decoder.model and np.array(reader.decoder.model), {}).read("any words") == set()


def test_near_copies_take_no_ngram_away(spark):
    chars = toxicity.log_model(np.zeros((toxicity.CLASSES,) * 3))
    own = [f"left{k} idiot right{k} more words" for k in range(16)]
    copies = [f"what an idiot and a wombat they all said number{k} again" for k in range(240)]
    rows = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    chosen = ["^idiot$", "^wombat$"]
    assert toxicity._spread(rows(own), chars, chosen) == ["^idiot$"]
    assert toxicity._spread(rows(own + copies), chars, chosen) == ["^idiot$"]
    assert toxicity._spread(rows(copies), chars, chosen) == []


def test_held_out_accuracy(spark):
    docs, labels = load(spark, SF_ORACLE, "documents"), load(spark, SF_ORACLE, "labels")
    model = toxicity.train(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    clean = [scores[r.doc_id] for r in held if r.toxic == 0]
    toxic = [scores[r.doc_id] for r in held if r.toxic == 1]
    assert sum(s >= 0.7 for s in clean) == 0
    assert sum(s >= 0.7 for s in toxic) >= 0.6 * len(toxic)


def test_odd_documents(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, None), (9, 0), (None, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count()
    assert toxicity.score(no_docs(spark), model).count() == 0
    empty = toxicity.train(no_docs(spark), labels.where("false"))
    assert len({r.score for r in toxicity.score(docs, empty).collect()}) == 1
