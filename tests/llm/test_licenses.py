from __future__ import annotations

import random
import re

from beforeafter.llm import licenses
from tests.conftest import SF_ORACLE
from tests.llm.helpers import load, no_docs, odd_docs


def grams(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "" if c not in licenses.PUNCTUATION)
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def plain(docs, templates=licenses.TEMPLATES):
    out = []
    for i, text in docs:
        own = grams(text)
        for t in templates:
            s = grams(t.text)
            if s and len(own & s) / len(s) >= 0.8:
                out.append((i, t.name, len(own & s), len(s)))
    return sorted(out, key=str)


def got(docs, templates=None):
    rows = licenses.scan_licenses(docs, templates).collect()
    assert all(abs(r.containment - r.n_shared / r.n_template) < 1e-12 for r in rows)
    return sorted(((r.doc_id, r.license, r.n_shared, r.n_template) for r in rows), key=str)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_scan_against_brute_force(spark):
    docs = load(spark, SF_ORACLE, "documents")
    wanted = plain(pairs(docs))
    assert got(docs) == wanted and wanted


def test_changed_copies_anywhere_in_a_text(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        t = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        ws = t.text.split()
        for _ in range(rng.randrange(4)):
            ws[rng.randrange(len(ws))] = rng.choice(["CHANGED", "(other)", "words"])
        before = [f"w{rng.randrange(999)}" for _ in range(rng.randrange(200))]
        after = [f"w{rng.randrange(999)}" for _ in range(rng.randrange(200))]
        rows.append((k, " ".join([*before, *ws, *after]), "en", "a"))
    docs = odd_docs(spark, rows)
    wanted = plain(pairs(docs))
    assert got(docs) == wanted and 100 < len(wanted) < 300


def test_odd_documents(spark):
    mit = licenses.TEMPLATES[1].text
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, mit, "en", "a"), (3, mit.upper(), "en", "a"),
            (3, mit.upper(), "en", "a"), (4, "x " * 20000 + mit, "en", "a"), (5, "released under the", "en", "a")]
    docs = odd_docs(spark, rows)
    wanted = plain(rows_of(rows))
    assert got(docs) == wanted and len(wanted) == 4
    assert got(no_docs(spark)) == []
    assert got(docs, []) == [] and got(docs, [licenses.Template("short", "two words")]) == []
    assert got(odd_docs(spark)) == []


def rows_of(rows):
    return [(r[0], r[1]) for r in rows]
