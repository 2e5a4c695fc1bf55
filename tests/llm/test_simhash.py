from __future__ import annotations

import itertools

import numpy as np
from xxhash import xxh64_intdigest

from beforeafter.llm import simhash
from beforeafter.llm import components
from beforeafter.llm.components import connected_components, join_hubs
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs


def plain_fingerprint(text, k=4):
    ws = (text or "").encode().lower().split()
    grams = [b" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """doc rows (id, fingerprint) -> component id per row, by brute force."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def up(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 4:
            root[up(a)] = up(b)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[up(f)] = min(least.get(up(f), i), i)
    return [(i, f, least.get(up(f))) for i, f in pairs]


def check(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    wanted = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()])
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == sorted(wanted, key=str)


def test_near_duplicates_against_brute_force(spark):
    check(spark, load(spark, SF_ORACLE, "documents"))


def test_odd_documents(spark):
    check(spark, odd_docs(spark))
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    kept = simhash.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert {r.doc_id for r in kept.collect()} >= {None, 1, 4}
    assert simhash.keep_first(no_docs(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Also where doc_ids repeat on different texts, or are missing."""
    texts = {k: f"text number {k} " + " ".join(f"w{k}x{j}" for j in range(40)) for k in "abcdef"}
    own = [(1, "a"), (2, "a"), (2, "b"), (2, "b"), (2, "c"), (3, "c"), (0, "c"), (None, "d"), (None, "d"), (5, "e"),
           (None, "e"), (5, "e"), (7, "f"), (7, "f")]
    docs = odd_docs(spark, [(i, texts[t], "en", "a") for i, t in own])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    wanted = [(1, "a"), (2, "b"), (0, "c"), (None, "d"), (5, "e"), (7, "f")]
    assert found == sorted(((i, texts[t]) for i, t in wanted), key=str)


def test_code_is_perfect():
    words = np.arange(1 << 12, dtype=np.uint32) * 2048 + 77
    keys, n = simhash.golay_keys(words)
    assert set(n) <= {1, 6}
    # a codeword has itself as its only key
    for index in (0, 1, 77, 4095):
        word = np.array([index << 11 | simhash._remainder(index << 11)], np.uint32)
        k, n = simhash.golay_keys(word)
        assert n[0] == 1 and k[0, 0] == index


def test_segments_within_two_bits_share_a_key():
    rng = np.random.default_rng(3)
    flips = [0, *(1 << a for a in range(23)), *(1 << a | 1 << b for a, b in itertools.combinations(range(23), 2))]
    for word in rng.integers(0, 1 << 23, 200):
        k, n = simhash.golay_keys(np.array([int(word) ^ f for f in flips], np.uint32))
        own = set(k[0, : n[0]])
        assert all(own & set(k[i, : n[i]]) for i in range(len(flips)))


def test_every_pair_within_four_bits_is_linked():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, i % 5, replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    keys, fps = simhash.fuzzy_keys(np.unique(np.concatenate([a, b])))
    child, parent = simhash.verified_links(keys, fps, 4)
    up = dict(zip(child.tolist(), parent.tolist()))
    top = lambda f: top(up[f]) if f in up else f
    assert all(top(int(x)) == top(int(y)) for x, y in zip(a, b))


def test_long_runs_are_searched_like_short_ones():
    rng = np.random.default_rng(5)
    center = np.uint64(0x123456789ABCDEF0)
    fps = np.unique(np.array([center ^ np.uint64(1 << int(x) | 1 << int(y)) for x, y in rng.integers(0, 64, (300, 2))]))
    far = fps ^ np.uint64(0xFFFF000000000000)
    keys = np.zeros(2 * len(fps), np.uint64)
    every = np.concatenate([fps, far])
    groups = set()
    for wide in (2, 1000):
        child, parent = simhash.verified_links(keys, every, 4, wide)
        root = dict(zip(child.tolist(), parent.tolist()))
        groups.add(frozenset((int(f), root.get(int(f), int(f))) for f in every))
        assert len({root.get(int(f), int(f)) for f in every}) == 2
    assert len(groups) == 1


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}}
    assert connected_components(df.where("false")).count() == 0


def test_hubs_are_joined_where_they_are(spark, monkeypatch):
    """Frequent and rare keys give the rows of a plain join; only rare keys are shuffled."""
    monkeypatch.setattr(components, "HUBS", 3)
    rows = spark.createDataFrame([(k % 4 if k < 90 else k, k) for k in range(100)], "u long, v long")
    table = rows.groupBy("u").count().selectExpr("u", "u * 10 AS m", "count AS n")
    got = join_hubs(rows, table, "u", 100)
    assert sorted(got.collect()) == sorted(rows.join(table.drop("n"), "u").collect())
    assert table.where(f"n > {100 // 3}").count() <= 3
    assert join_hubs(rows.where("false"), table.where("false"), "u", 0).count() == 0
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 160)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{k: 100 for k in range(100, 160)}}
