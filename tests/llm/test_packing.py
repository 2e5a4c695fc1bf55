from __future__ import annotations

import random
import struct
import zlib

import pytest
from tokenizers import Tokenizer

from beforeafter.llm import packing
from beforeafter.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import load, no_docs, odd_docs


def optimum(items, capacity):
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[k] -= items[i]
            go(i + 1, rooms)
            rooms[k] += items[i]
        rooms.append(capacity - items[i])
        go(i + 1, rooms)
        rooms.pop()

    go(0, [])
    return best[0]


def histogram(items):
    return {s: items.count(s) for s in set(items)}


def test_search_finds_the_optimum_of_small_cases():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([20, 50, 100])
        items = [rng.randint(capacity // 6, capacity // 2 + 5) for _ in range(rng.randint(1, 11))]
        patterns = packing.bin_completion(histogram(items), capacity)
        placed = sorted(s for fill, n in patterns for s in fill * n)
        assert placed == sorted(items)
        assert all(sum(fill) <= capacity for fill, _ in patterns)
        assert sum(n for _, n in patterns) == optimum(items, capacity)


def test_search_is_no_worse_than_best_fit_and_bounded():
    rng = random.Random(2)
    for _ in range(4):
        items = [min(2048, max(1, int(rng.gauss(900, 400)))) for _ in range(3000)]
        hist = histogram(items)
        found = sum(n for _, n in packing.bin_completion(hist, 2048))
        fit = sum(n for _, n in packing.best_fit_decreasing(hist, 2048))
        assert packing.lower_bound(hist, 2048) <= found <= fit


def test_search_beats_best_fit_on_many_lengths():
    rng = random.Random(0)
    items = [min(2048, max(1, int(rng.gauss(700, 150)))) for _ in range(20000)]
    hist = histogram(items)
    assert len(hist) > 850
    patterns = packing.bin_completion(hist, 2048)
    placed = {}
    for fill, n in patterns:
        assert sum(fill) <= 2048
        for s in fill:
            placed[s] = placed.get(s, 0) + n
    assert placed == hist
    assert sum(n for _, n in patterns) < sum(n for _, n in packing.best_fit_decreasing(hist, 2048))


def test_dominance():
    assert packing.undominated([(5, 5), (10,), (4,)]) == [(10,)]
    assert set(packing.undominated([(6, 3), (5, 4)])) == {(6, 3), (5, 4)}
    assert packing.bin_completion({1: 3000}, 2048) and packing.bin_completion({}, 10) == []
    with pytest.raises(ValueError):
        packing.bin_completion({11: 1}, 10)


def check_packed(found, texts, capacity):
    """Token ids as the tokenizer gives them, and gapless sequences."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = []
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted.append((doc_id, p, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_are_packed_whole(spark):
    docs = load(spark, SF_SMALL, "documents")
    found = packing.pack_documents(docs, tokenizer_path()).collect()
    n = check_packed(found, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert n <= -(-sum(r["length"] for r in found) // 2048) + 2


def test_odd_documents(spark):
    docs = odd_docs(spark)
    found = packing.pack_documents(docs, tokenizer_path(), capacity=64).collect()
    check_packed(found, [(r.doc_id, r.text) for r in docs.collect()], 64)
    assert packing.pack_documents(no_docs(spark), tokenizer_path()).count() == 0


def test_words_are_encoded_as_in_the_text():
    encoder = packing.WordEncoder(tokenizer_path(), max_words=50)  # emptied again and again
    whole = Tokenizer.from_file(tokenizer_path())
    texts = [
        "It's WE'RE <|endoftext|> Ünï ＡＢ\x0bx ΣΑΣ ﬁ İ 12,5 a||b ||. é́ ñ̃   \x1c z",
        "<|STARTOFTEXT|> École, ÉCOLE! ŉ ſ ĳ naïve... 'tis d'un",
        " ".join(chr(c) + "a" + chr(c) for c in range(0xA0, 0x250)),
    ]
    for text, got in zip(texts, encoder.encode_batch([t.encode() for t in texts])):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert got == struct.pack(f"<{len(ids)}I", *ids)
