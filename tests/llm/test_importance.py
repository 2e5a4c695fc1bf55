from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from beforeafter.llm import importance
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(g):
    return zlib.crc32(g.encode()) % 10000


def plain(docs, target, percent=25, seed=7):
    s = Counter(bucket(g) for _, t in docs for g in grams(t)[1])
    t = Counter(bucket(g) for x in target for g in grams(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s
    }
    out = []
    for i, x in docs:
        w, g = grams(x)
        weight = sum(gain[bucket(f)] for f in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(w), len(g), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = k
    return sorted(map(tuple, out), key=str)


def check(docs, target, percent=25):
    found = importance.resample(docs, target, percent=percent)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    wanted = plain(
        [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
        [r.text for r in target.select("text").collect()],
        percent,
    )
    assert got == wanted
    return got


def test_against_plain_python(spark):
    got = check(load(spark, SF_ORACLE, "documents").repartition(7), load(spark, SF_ORACLE, "benchmark"))
    assert sum(r[5] is not None for r in got) == sum(r[1] >= 20 for r in got) // 4


def test_odd_documents(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice(["Äpfel", "x" * 300, "don't", "e\x00f", "naïve", "ab12", "日本語"]) for _ in range(4000))
    rows = [(i, long if i % 3 else long[:500].upper(), "en", "a") for i in range(9)] * 2
    rows += [(None, long, "en", "a"), (50, None, None, None), (51, "", "en", "a"), (52, "!!! ???", "en", "a"), (53, "one", "en", "a")]
    target = load(spark, SF_ORACLE, "benchmark")
    check(odd_docs(spark, rows), target, percent=60)
    check(odd_docs(spark), target, percent=100)
    check(odd_docs(spark), target.where("false"))
    assert importance.resample(no_docs(spark), target).count() == 0


def test_neighbours_in_a_batch_share_no_pair():
    shift = importance.Shift()
    bucket_, of, n = importance.features([b"aa bb", b"cc", b"", b"\x00dd"], 10**9, shift)
    crc = {zlib.crc32(w) % 10**9 for w in (b"aa", b"bb", b"cc", b"dd", b"aa bb")}
    assert set(bucket_.tolist()) == crc and list(n) == [2, 1, 0, 1] and sorted(of) == [0, 0, 0, 1, 3]


def test_combined_hashes():
    rng = random.Random(4)
    words = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 2, 5, 9, 47, 48, 49, 500]))) for _ in range(400)]
    blob = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    crc = importance.word_crcs(blob, starts, ends)
    assert crc.tolist() == [zlib.crc32(w) for w in words]
    pairs = importance.pair_crcs(crc[:-1], crc[1:], (ends - starts)[1:], importance.Shift())
    assert pairs.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]
