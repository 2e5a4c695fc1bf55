from __future__ import annotations

import re
from itertools import permutations
from math import factorial

from beforeafter.llm import filteraudit
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs

FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_masks(docs, labels):
    smallest = {}
    for i, _, t in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = []
    for i, lang, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > smallest[t],
        }
        out.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    return out


def plain(docs, labels):
    """Every order run step by step."""
    rows = plain_masks(docs, labels)
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        taken = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                taken[f] += len(gone)
                out[part, order, k] = [
                    len(left),
                    len(gone),
                    sum(f in r[1] for r in mine) - len(gone),
                    sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone),
                    sum(r[3] for r in gone),
                ]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(taken[order[k - 1]])
    return out


def check(docs, labels):
    found = filteraudit.audit(filteraudit.failures(docs, labels))
    got = {(r.part, r.filter_order, r.step): [r[c] for c in FIGURES] for r in found.collect()}
    wanted = plain(
        [(r.doc_id, r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()],
        [(r.doc_id, r.quality, r.toxic) for r in labels.select("doc_id", "quality", "toxic").collect()],
    )
    assert got == wanted
    return got


def test_against_running_every_order(spark):
    got = check(load(spark, SF_ORACLE, "documents"), load(spark, SF_ORACLE, "labels"))
    for part in {p for p, _, _ in got}:
        total = got[part, "ABCDE", 1][0] + got[part, "ABCDE", 1][1]
        assert all(sum(got[part, "".join(o), k][1] for k in range(1, 6)) == total - got[part, "".join(o), 5][0] for o in permutations("ABCDE"))


def test_odd_documents_and_labels(spark):
    extra = [(i, " ".join(f"w{j}" for j in range(120)), "en", "a") for i in (20, 21, 21, 22, None, None)]
    extra += [(23, extra[0][1], "de", "a"), (24, None, None, "a"), (25, "", "", "a"), (26, "SHOUT #1", "en", "a")]
    labels = spark.createDataFrame(
        [(20, 1, 0, "x"), (21, None, 1, "x"), (21, 1, None, "x"), (23, 1, 1, "x"), (26, 0, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")],
        "doc_id long, quality int, toxic int, part string",
    )
    check(odd_docs(spark, extra), labels)
    check(odd_docs(spark), labels)
    check(odd_docs(spark), labels.where("false"))
    assert filteraudit.audit(filteraudit.failures(no_docs(spark), labels)).count() == 0


def test_paths_through_the_lattice():
    for n in range(1, 7):
        lattice = filteraudit.Lattice.of(n)
        for s in range(1 << n):
            size = bin(s).count("1")
            assert (lattice.reach[s], lattice.leave[s]) == (factorial(size), factorial(n - size))
        edges = lattice.edges()
        assert len(edges) == n << (n - 1)
        for f in range(n):  # every order passes each filter once
            assert sum(p for _, g, p in edges if g == f) == factorial(n)


def test_another_number_of_filters(spark):
    counts = spark.createDataFrame(
        [("x", 0, 5, 0, 0), ("x", 1, 2, 1, 0), ("x", 3, 4, 0, 4)], "part string, mask int, n long, good long, toxic long"
    )
    got = {(r.filter_order, r.step): [r[c] for c in FIGURES] for r in filteraudit.audit(counts, "PQ").collect()}
    assert got == {
        ("PQ", 1): [5, 6, 0, 2, 1, 4, 8],
        ("PQ", 2): [5, 0, 4, 0, 0, 0, 4],
        ("QP", 1): [7, 4, 0, 0, 0, 4, 4],
        ("QP", 2): [5, 2, 4, 2, 1, 0, 8],
    }
