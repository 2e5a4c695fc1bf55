from __future__ import annotations

import numpy as np

import corpus_pipeline
from beforeafter.llm import mixing, queries
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs


def plain_targets(sizes):
    """{source: size} -> {source: target}: share again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(full.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * level >= 3 * sizes[s]]
        if not over:
            return {s: full.get(s, weight[s] * level) for s in names}
        full |= {s: 3 * sizes[s] for s in over}


def test_targets_are_shared_again_until_none_is_above(spark):
    rng = np.random.default_rng(0)
    for _ in range(6):
        sizes = {f"s{k}": int(rng.integers(0, 10 ** int(rng.integers(1, 6)))) for k in range(int(rng.integers(1, 9)))}
        sizes[None] = int(rng.integers(0, 500))
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        wanted = plain_targets(sizes)
        assert all(abs(got[s] - wanted[s]) < 1e-6 * max(1, wanted[s]) for s in sizes)
        assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6 * max(1, sum(sizes.values()))


def test_splitting_tree_is_exact():
    quotas = [5, 0, 1200, 77, 3]
    for shards in (1, 2, 3, 8, 13):
        split = mixing.split_quotas(quotas, shards, 7)
        assert split.sum(1).tolist() == quotas and (split >= 0).all()
        assert split.sum(0).max() - split.sum(0).min() <= 1
        assert (split == mixing.split_quotas(quotas, shards, 7)).all()
    assert mixing.split_quotas([], 4, 1).shape == (0, 4)
    # the mean of the draws is the proportional share
    mean = np.mean([mixing.split_quotas([100, 300], 2, s)[0, 0] for s in range(400)])
    assert abs(mean - 50) < 1


def test_mixture_meets_its_targets(spark):
    docs = load(spark, SF_ORACLE, "documents")
    plan = mixing.mix(docs).plan().join(docs.select("doc_id", "source"), "doc_id").collect()
    largest = max(r.size for r in plan)
    for source in {r.source for r in plan}:
        own = [r for r in plan if r.source == source]
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.size * r.times for r in own) - own[0].target) <= largest / 2
        assert max(r.times for r in own) <= 3
    again = mixing.mix(docs.repartition(7)).plan().collect()
    assert {(r.doc_id, r.times) for r in plan} == {(r.doc_id, r.times) for r in again}


def test_shards_hold_the_drawn_rows_disjointly(spark, tmp_path):
    docs = load(spark, SF_ORACLE, "documents")
    mixture = mixing.mix(docs, seed=3, shards=5)
    rows = mixture.rows().collect()
    times = {r.doc_id: r.times for r in mixture.plan().collect()}
    assert len(rows) == sum(times.values())
    drawn = {}
    for r in rows:
        drawn[r.doc_id] = drawn.get(r.doc_id, 0) + 1
    assert drawn == {i: t for i, t in times.items() if t}
    assert {r.shard for r in rows} == set(range(5))
    slots = np.array([q for _, q in mixture.quotas()])
    assert slots.sum(0).max() - slots.sum(0).min() <= 1
    mixture.write(str(tmp_path / "mix"))
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert written.count() == len(rows)
    plain = mixture.rows(place=False)
    assert plain.columns == docs.columns and plain.count() == len(rows)


def test_odd_documents(spark):
    docs = odd_docs(spark)
    mixture = mixing.mix(docs)
    plan = mixture.plan().collect()
    assert len(plan) == docs.count()
    twice = [r.times for r in plan if r.doc_id == 9]
    assert len(set(twice)) == 1
    assert mixture.rows().count() == sum(r.times for r in plan)
    assert mixture.rows(place=False).columns == docs.columns
    empty = mixing.mix(no_docs(spark))
    assert empty.plan().count() == 0 and empty.rows().count() == 0


def test_registered_paths_draw_what_the_tree_hands_out(spark, monkeypatch):
    docs = load(spark, SF_ORACLE, "documents")
    placed = mixing.mix(docs).rows().select("doc_id", "shard", "shuffle_key").collect()
    wanted = [r.doc_id for r in sorted(placed, key=lambda r: (r.shard, r.shuffle_key))]
    assert [r.doc_id for r in corpus_pipeline.source_mix(spark, docs, SF_ORACLE).collect()] == wanted
    # the slots of a shard that the tree does not hand out are not drawn
    whole = mixing.split_quotas

    def without_last(quotas, shards, seed):
        out = whole(quotas, shards, seed)
        out[:, -1] = 0
        return out

    monkeypatch.setattr(mixing, "split_quotas", without_last)
    left = {}
    for r in mixing.mix(docs).rows().collect():
        left[r.doc_id] = left.get(r.doc_id, 0) + 1
    got = {r.doc_id: (r.size, r.taken) for r in queries.source_mixing(spark, SF_ORACLE).collect()}
    assert 0 < sum(left.values()) < len(placed)
    assert all(taken == size * left.get(i, 0) for i, (size, taken) in got.items())
