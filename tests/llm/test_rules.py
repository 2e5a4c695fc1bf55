from __future__ import annotations

import re

from beforeafter.llm import rules
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import load, no_docs, odd_docs


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, g in enumerate(windows) if windows.count(g) > 1 for k in (i, i + 1, i + 2)} if len(words) < 3000 else None
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": None if inside is None else len(inside),
        "n_lines": len(lines),
        "n_upper": sum(c.isupper() and len(c) == 1 for c in text),
        "n_exclaim": text.count("!"),
    }


def check(docs):
    got = rules.ledger(docs).collect()
    for r in got:
        wanted = plain(r.text)
        for name, value in wanted.items():
            assert value is None or r[name] == value, (r.doc_id, name)
        failed = 0
        for b, (_, condition) in enumerate(rules.RULES):
            failed |= eval(condition, {}, {n: r[n] for n in rules.MEASURES}) << b  # noqa: S307
        assert r.failed == failed
    return got


def test_ledger_against_plain_python(spark):
    check(load(spark, SF_SMALL, "documents"))
    check(odd_docs(spark))


def test_policies_are_masks(spark):
    docs = load(spark, SF_ORACLE, "documents")
    kept = {r.doc_id for r in rules.apply_policy(docs).collect()}
    # a condition on the ledger itself, not on a stored copy
    assert kept == {r.doc_id for r in rules.ledger(docs).where(rules.passes(rules.STRICT)).select("doc_id").collect()}
    long = {r.doc_id for r in rules.measure(docs).where("n_repeat_words > 9 and n_words > 80").select("doc_id").collect()}
    ledger = rules.ledger(docs).cache()
    assert long and long == {r.doc_id for r in ledger.where("n_repeat_words > 9 and n_words > 80").collect()}
    assert kept == {r.doc_id for r in ledger.where(rules.passes(rules.STRICT)).collect()}
    assert kept < {r.doc_id for r in ledger.where(rules.passes(rules.BASE)).collect()}
    labels = {r.doc_id: r.quality for r in load(spark, SF_ORACLE, "labels").collect()}
    clean = {r.doc_id for r in ledger.where("n_words >= 50").collect() if labels.get(r.doc_id) == 1}
    assert clean <= kept and not any(labels.get(i) == 0 for i in kept)
    ledger.unpersist()


def test_ablations_count_from_the_masks(spark):
    ledger = spark.createDataFrame([(0,), (0,), (1,), (1,), (3,), (4,), (6,)], "failed long")
    policy = rules.Policy("t", ("few_words", "repeated_words"))
    found = {r.rule: r for r in rules.ablations(ledger, [policy]).collect()}
    few, repeated = found["few_words"], found["repeated_words"]
    assert (few.kept, few.rejected, few.only_this_rule, few.kept_without) == (3, 3, 2, 5)
    assert (repeated.kept, repeated.rejected, repeated.only_this_rule, repeated.kept_without) == (3, 2, 1, 4)
    empty = rules.ablations(ledger.where("false"), [policy]).collect()
    assert len(empty) == 2 and all(r.kept == 0 for r in empty)


def test_odd_documents(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    docs = odd_docs(spark, [(4, long, "en", "a"), (4, long, "en", "a"), (None, long, None, None), (5, None, "en", "a"), (6, "", "en", "a")])
    kept = rules.apply_policy(docs)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.failed, r.n_lines) for r in kept.collect()] == [(4, "f", "n"), (4, "f", "n"), (None, "f", "n")]
    assert rules.apply_policy(odd_docs(spark)).count() == 0  # the long text there is full of symbols
    assert rules.apply_policy(no_docs(spark)).count() == 0
    assert rules.ledger(no_docs(spark)).count() == 0
