from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from beforeafter.llm import streamdedup
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs

SCHEMA = "doc_id long, text string, file string, _metadata string"


def short(text):
    """A digest of sixteen values: most texts share theirs with others."""
    return F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(text.cast("binary"), 256), 1, 1)))


def plain(rows):
    """{(doc_id, text): (keep_id, group_size)}"""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""])) for i, t in rows), key=str)


def check(store, rows):
    found = streamdedup.verdicts(store).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == plain(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)
    return found


@pytest.mark.parametrize("digest", [streamdedup.sha256, short])
def test_deliveries_one_after_the_other(spark, tmp_path, digest):
    rows = [(r.doc_id, r.text) for r in load(spark, SF_ORACLE, "documents").where("doc_id < 260").collect()]
    rows += [(500 + k, t) for k, (_, t) in enumerate(rows[::3])] + [(None, None), (3, ""), (3, "")]
    store = streamdedup.Store(
        spark, str(tmp_path / "store"), spark.createDataFrame([], SCHEMA).schema, digest=digest
    )
    taken = []
    for part in (rows[200:], rows[:120], rows[120:200]):
        spark.createDataFrame([(i, t, "own", "own") for i, t in part], SCHEMA).repartition(2).write.mode("append").parquet(
            str(tmp_path / "docs")
        )
        streamdedup.ingest(store, str(tmp_path / "docs"))
        taken += part
        check(store, taken)
    streamdedup.ingest(store, str(tmp_path / "docs"))  # nothing new
    check(store, taken)
    clashes = streamdedup.collided(store).count()
    assert clashes == 0 if digest is streamdedup.sha256 else clashes > 8
    docs = spark.read.schema(store.schema).parquet(str(tmp_path / "docs"))
    stay = streamdedup.kept_documents(store, docs)
    assert stay.columns == docs.columns
    texts = [r.text or "" for r in stay.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in rows})


def test_state_keeps_the_first_content_and_the_largest_id(spark, tmp_path):
    store = streamdedup.Store(spark, str(tmp_path / "store"), spark.createDataFrame([], SCHEMA).schema, batch_bytes=1)
    for i in (5, 9, 7):
        spark.createDataFrame([(i, "the text", "", ""), (i + 100, f"alone {i}", "", "")], SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(str(tmp_path / "docs"))
        streamdedup.ingest(store, str(tmp_path / "docs"))
        state = {bytes(r.digest): r for r in streamdedup.retained(store).collect()}
        r = state[hashlib.sha256(b"the text").digest()]
        assert (r["first"].doc_id, r.keep.doc_id) == (5, max(x for x in (5, 9, 7)[: r.n]))
    assert r.n == 3 and len(state) == 4


def test_wrong_content_under_a_digest_is_noticed_in_a_later_delivery(spark, tmp_path):
    store = streamdedup.Store(
        spark, str(tmp_path / "store"), spark.createDataFrame([], SCHEMA).schema, digest=lambda t: F.lit(b"x")
    )
    rows = []
    for i, t in ((1, "one"), (2, "two"), (3, "one")):
        spark.createDataFrame([(i, t, "", "")], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
        streamdedup.ingest(store, str(tmp_path / "docs"))
        rows.append((i, t))
        check(store, rows)
        assert streamdedup.collided(store).count() == (i > 1)


def test_odd_and_no_documents(spark, tmp_path):
    odd = odd_docs(spark)
    odd.write.parquet(str(tmp_path / "odd"))
    store = streamdedup.Store(spark, str(tmp_path / "s1"), odd.schema)
    streamdedup.ingest(store, str(tmp_path / "odd"))
    check(store, [(r.doc_id, r.text) for r in odd.collect()])
    no_docs(spark).write.parquet(str(tmp_path / "none"))
    empty = streamdedup.Store(spark, str(tmp_path / "s2"), odd.schema)
    streamdedup.ingest(empty, str(tmp_path / "none"))
    assert streamdedup.verdicts(empty).count() == 0 and streamdedup.collided(empty).count() == 0
