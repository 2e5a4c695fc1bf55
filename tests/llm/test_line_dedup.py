from __future__ import annotations

from collections import defaultdict

import pytest

from beforeafter.llm import linededup
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def plain(docs, min_chars=40, min_docs=5):
    """(doc_id, text) rows -> (doc_id, kept text, lines, dropped)."""
    holders = defaultdict(set)
    for n, (i, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i if i is not None else ("row", text))
    often = {}
    for k, found in holders.items():
        if len(found) >= min_docs:
            often[k] = max((i for i in found if not isinstance(i, tuple)), default=object())
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in often or often[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def check(docs, **how):
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in linededup.dedup_lines(docs, **how).collect()]
    same = {k: v for k, v in how.items() if k.startswith("min_")}
    wanted = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], **same)
    assert sorted(got, key=str) == sorted(wanted, key=str)
    return sum(r[3] for r in got)


@pytest.mark.parametrize("batches,fanout", [(1, 4), (4, 2), (7, 3)])
def test_batches_and_levels_do_not_change_the_result(spark, batches, fanout):
    assert check(load(spark, SF_ORACLE, "documents"), batches=batches, fanout=fanout)


def test_odd_documents(spark):
    docs = odd_docs(spark)
    assert check(docs) > 3
    assert check(docs, min_docs=2, min_chars=5) > 3
    out = linededup.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert linededup.dedup_lines(no_docs(spark)).count() == 0


def test_rows_without_an_id_keep_nothing(spark):
    line = "a line without any document id to keep it, long enough"
    docs = odd_docs(spark, [(None, f"{line}\n{k}", "en", "a") for k in range(6)])
    assert {r.text for r in linededup.dedup_lines(docs).collect()} == {str(k) for k in range(6)}


def test_settled_lines_leave_the_runs(spark):
    counts = lambda rows: spark.createDataFrame(rows, "h1 long, h2 long, n_docs long, keep_id long")
    runs = linededup.LineRuns(spark, min_docs=5, fanout=3, buckets=4)
    runs.add(counts([(1, 1, 6, 90), (2, 2, 3, 95)]))
    runs.add(counts([(1, 1, 4, 50), (2, 2, 1, 40), (3, 3, 5, 45)]))
    second = {tuple(r) for r in runs.runs()[1].table.collect()}
    assert second == {(2, 2, 1, 40), (3, 3, 5, 45)}  # line 1 was settled
    runs.add(counts([(2, 2, 1, 30), (3, 3, 1, 99)]))
    assert len(runs.runs()) == 1 and len(runs.levels) == 2
    assert {tuple(r) for r in runs.repeated().collect()} == {(1, 1, 90), (2, 2, 95), (3, 3, 99)}
