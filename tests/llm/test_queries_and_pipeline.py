from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from beforeafter.llm import queries, rules
from tests.conftest import SF_ORACLE
from tests.llm.helpers import duck, load, no_docs, odd_docs, rows, same_rows
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_packing import check_packed
from tests.llm.test_simhash import plain_components, plain_fingerprint

TABLES = ["documents", "benchmark", "embeddings", "labels", "conversations"]


def test_every_operator_is_registered_once():
    found = entry.queries()
    assert {int(m[1]) for n in found if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in found and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    paths = {t: f"{SF_ORACLE}/{t}.parquet" for t in TABLES}
    got = rows(queries.QUERIES[name](spark, SF_ORACLE))
    same_rows(got, duck(queries.ORACLE[name], **paths), close=("target", "containment"))


def test_stages_against_brute_force(spark):
    docs = load(spark, SF_ORACLE, "documents")
    for name, step in corpus_pipeline.STAGES[:3]:
        before = docs.collect()
        docs = step(spark, docs, SF_ORACLE).cache()
        after = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_rules":
            kept = {r.doc_id for r in rules.ledger(spark.createDataFrame(before)).where(rules.passes(rules.STRICT)).collect()}
            assert {r.doc_id for r in after} == kept and len(kept) < len(before)
        elif name == "line_dedup":
            wanted = {(i, t) for i, t, _, _ in plain_lines([(r.doc_id, r.text) for r in before])}
            assert {(r.doc_id, r.text) for r in after} == wanted
            assert all(r.n_chars == len(r.text) for r in after)
        else:
            groups = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in before])
            assert {r.doc_id for r in after} == {c for _, _, c in groups} and len(after) < len(before)
    mixed = corpus_pipeline.source_mix(spark, docs, SF_ORACLE).cache()
    assert mixed.columns == docs.columns
    most = mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert 1 < most <= 3
    packed = corpus_pipeline.pack(spark, mixed, SF_ORACLE).collect()
    check_packed(packed, [(r.doc_id, r.text) for r in mixed.collect()], 2048)


def test_stages_take_odd_and_no_documents(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, SF_ORACLE)
            assert name == "pack" or out.columns == docs.columns
            out.count()
