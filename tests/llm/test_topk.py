from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from beforeafter.llm import topk
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load


def plain(rows, k=5, every=50):
    use = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in use:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def got(df, **how):
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, **how)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


def test_search_against_brute_force(spark):
    df = load(spark, SF_ORACLE, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == plain(rows)
    assert got(df.repartition(5), block=64, query_block=3) == plain(rows)


def test_odd_vectors(spark):
    rng = random.Random(1)
    few = [rng.uniform(-1, 1) for _ in range(6)]
    rows = [
        (0, few),
        (50, few),
        (1, few),
        (2, few),
        (2, few),
        (3, None),
        (4, [0.5, None]),
        (5, [float("nan"), 1.0]),
        (6, [float("inf")]),
        (7, []),
        (8, [0.25, 0.5]),
        (None, few),
        (100, [0.0] * 6),
        (9, [-x for x in few]),
    ]
    df = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, block int, data string"
    )
    wanted = plain([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert got(df) == wanted and wanted
    assert got(df, block=2, query_block=1) == wanted
    assert got(df.where("false")) == []
    assert got(df.where("vec_id = 50")) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, 1.0]), (1, [3e5, 2.0]), (2, [3e5, 3.0]), (3, [-3e5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df) == plain(rows)
    huge = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<double>")
    assert [x[2:] for x in got(huge)] == [(1, 2**63 - 1), (2, -(2**63))]


def test_pruning_drops_candidates_and_keeps_ties():
    rng = np.random.default_rng(2)
    x = rng.integers(-200, 200, (64, 800)).astype(float)
    x[:, 400:420] = x[:, :1]
    ids = rng.permutation(800)
    at_q, at_x, scores = topk.search_block(x[:, :30], ids[:30], x, ids, 5)
    for i in range(30):
        s = (x[:, i] @ x).astype(int)
        wanted = sorted((-int(s[j]), int(ids[j])) for j in range(800) if j != i)[:5]
        assert [(-a, int(ids[j])) for a, j, q in zip(scores, at_x, at_q) if q == i] == wanted


def brute(q, q_ids, x, x_ids, k):
    whole = lambda m: [[int(v) for v in m[:, j]] for j in range(m.shape[1])]
    return [
        sorted((-sum(a * b for a, b in zip(own, c)), int(i)) for c, i in zip(whole(x), x_ids) if i != q_ids[j])[:k]
        for j, own in enumerate(whole(q))
    ]


def test_small_masses_beside_large_ones_count():
    q = np.array([[3.0] + [0.0] * 7 + [1.0] * 8]).T
    a = [2.0**40] + [0.0] * 7 + [1.0] * 8
    b = [2.0**40 + 1] + [0.0] * 15
    x, ids = np.array([a, b]).T, np.array([1, 2])
    _, at, scores = topk.search_block(q, np.array([0]), x, ids, 1)
    assert (list(at), scores) == ([0], [3298534883336])


def test_every_size_of_component_against_brute_force():
    rng = np.random.default_rng(6)
    for power in range(2, 30, 3):  # scores fit a long
        big = 2.0**power
        x = np.floor(rng.standard_cauchy((24, 60)).clip(-1, 1) * big)
        x[rng.random(x.shape) < 0.5] = rng.integers(-3, 4)
        x[:8, 1::2], x[8:, ::3] = np.floor(big / 2), 1
        x[:, 7] = x[:, 8]
        ids = rng.permutation(60)
        at_q, at_x, scores = topk.search_block(x[:, :12], ids[:12], x, ids, 3)
        for i, wanted in enumerate(brute(x[:, :12], ids[:12], x, ids, 3)):
            assert [(-s, int(ids[j])) for s, j, q in zip(scores, at_x, at_q) if q == i] == wanted
