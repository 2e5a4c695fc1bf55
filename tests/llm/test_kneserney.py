from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from beforeafter.llm import kneserney
from tests.conftest import SF_SMALL
from tests.llm.helpers import load, no_docs, odd_docs


class Plain:
    """The model in dictionaries."""

    def __init__(self, texts):
        seqs = [["<s>", *(t or "").encode().lower().split(), "</s>"] for t in texts]
        self.c1 = Counter(w for s in seqs for w in s[1:])
        self.c2 = Counter(p for s in seqs for p in zip(s, s[1:]))
        self.total, self.n = Counter(), defaultdict(lambda: [0, 0, 0])
        self.follows = Counter()
        for (a, b), c in self.c2.items():
            self.total[a] += c
            self.n[a][min(c, 3) - 1] += 1
            self.follows[b] += 1
        self.d2 = self.discount(self.c2.values())
        self.d1 = self.discount(self.follows.values())
        self.tokens, self.kinds = sum(self.c1.values()), len(self.c1)
        pairs = len(self.c2)
        self.left = sum(self.d1[min(c, 3) - 1] for c in self.follows.values()) / pairs if pairs else 0

    @staticmethod
    def discount(counts):
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        return [
            min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) if n[k] and n[k + 1] else 0.5 for k in (1, 2, 3)
        ]

    def lower(self, w):
        uniform = 1 / (self.kinds + 1)
        pairs = len(self.c2)
        if not pairs:
            return uniform
        c = self.follows[w]
        return (max(c - self.d1[min(c, 3) - 1], 0) / pairs if c else 0) + self.left * uniform

    def p(self, a, b):
        if not self.total[a]:
            return self.lower(b)
        c = self.c2[(a, b)]
        own = max(c - self.d2[min(c, 3) - 1], 0) if c else 0
        return (own + sum(d * n for d, n in zip(self.d2, self.n[a])) * self.lower(b)) / self.total[a]

    def score(self, text):
        s = ["<s>", *(text or "").encode().lower().split(), "</s>"]
        base = sum(math.log10((self.c1[w] + 1) / (self.tokens + self.kinds + 1)) for w in s[1:])
        return len(s) - 1, sum(w in self.c1 for w in s[1:]), base, sum(math.log10(self.p(a, b)) for a, b in zip(s, s[1:]))


def check(docs, train):
    model = kneserney.fit(train, shards=5)
    plain = Plain([r.text for r in train.select("text").collect()])
    assert (model.tokens, model.kinds, model.pairs) == (plain.tokens, plain.kinds, len(plain.c2))
    got = [tuple(r) for r in kneserney.score(docs, model).collect()]
    wanted = [(r.doc_id, *plain.score(r.text)) for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(wanted)
    for a, b in zip(sorted(got, key=str), sorted(wanted, key=str)):
        assert a[:3] == b[:3]
        assert np.allclose(a[3:], b[3:], rtol=1e-9)
    return model, plain


def test_scores_against_plain_python(spark):
    docs = load(spark, SF_SMALL, "documents")
    check(docs, docs.where(~kneserney.held_out()))


def test_probabilities_sum_to_one(spark):
    docs = odd_docs(spark)
    model, plain = check(docs, docs)
    scorer = kneserney.Scorer(model)
    ids = np.arange(1, model.bounds[-1] + 1, dtype=np.uint64)  # every token and the unknown word
    for first in (0, 2, 5, model.bounds[-1]):
        p = scorer.probability(np.full(len(ids), first, np.uint64), ids)
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_no_training_text(spark):
    docs = odd_docs(spark)
    check(docs, no_docs(spark))
    assert kneserney.score(no_docs(spark), kneserney.fit(docs)).count() == 0


def test_held_out_part_and_whole_query(spark):
    docs = load(spark, SF_SMALL, "documents")
    rows = docs.select("doc_id", kneserney.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows) and any(r.h for r in rows)
    scored, model = kneserney.score_all(docs)
    sums = scored.selectExpr("sum(score) s", "sum(base_score) b").first()
    assert sums.s > sums.b  # pairs tell more than single words


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    v = np.sort(rng.integers(0, 2**63, 1000).astype(np.uint64))
    assert (kneserney.unpack(kneserney.pack(v, True), True) == v).all()
    w = rng.integers(0, 9, 1000).astype(np.uint64)
    assert (kneserney.unpack(kneserney.pack(w, False), False) == w).all()
    assert len(kneserney.unpack(kneserney.pack(w[:0], True), True)) == 0
