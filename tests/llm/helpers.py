"""Small inputs that every operator must take: nulls, empty and long texts,
repeated rows, clashing column names, no rows."""

from __future__ import annotations

import random

CLASHING = (
    "doc_id long, text string, lang string, source string, n_chars long, failed string, n_lines string, shard int, "
    "_words string, _row string, size string, _key string, batch int"
)


def odd_docs(spark, rows=None):
    """Documents with extra columns whose names the operators use themselves."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "the", "of", "ünï", "<b>", "x|y", "end."]
    long = " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(6000))
    line = "This very line is common to several of the documents here."
    own = rows or [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, "   \n\t\n ", "en", "b"),
        (4, long, "de", "a"),
        (5, f"{line}\nown words five", "en", "a"),
        (6, f"{line}\nown words six", "en", "b"),
        (7, f"  {line.upper()}\t\nown words seven", "en", "b"),
        (8, f"{line}\n{line}\nown words eight", None, "c"),
        (9, f"own words nine\n{line}", "en", None),
        (9, f"own words nine\n{line}", "en", None),
        (None, f"no id here\n{line}", "en", "c"),
        (None, None, None, None),
        (10, "one two three one two three one two three four", "en", "a"),
    ]
    return spark.createDataFrame(
        [(i, t, la, s, len(t or ""), "f", "n", 7, "w", "r", "s", "k", 1) for i, t, la, s in own], CLASHING
    )


def no_docs(spark):
    return odd_docs(spark).where("false")


def load(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def duck(sql, **views):
    """Rows of DuckDB SQL over Parquet files, as a list of dicts."""
    import duckdb

    c = duckdb.connect()
    for name, path in views.items():
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    rel = c.sql(sql)
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]


def same_rows(got, expected, close=()):
    """Both are lists of dicts with the same rows, whatever the order."""
    key = lambda r: tuple(str(r[c]) for c in sorted(r) if c not in close)
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert set(a) == set(b)
        for c in a:
            if c in close:
                assert abs(a[c] - b[c]) <= 1e-9 * max(1.0, abs(b[c])), (c, a, b)
            else:
                assert a[c] == b[c], (c, a, b)


def rows(df):
    return [r.asDict() for r in df.collect()]
