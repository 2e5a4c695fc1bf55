"""Column helpers: month keys, text, numbers, exact quantiles."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from beforeafter.functions.months import month_end, month_key, month_sort_key
from beforeafter.functions.numeric import ravg, rsum, to_number
from beforeafter.functions.text import direction, fmt, safe
from beforeafter.operators.quantiles import exact_quantiles, exact_quantiles_of


def test_month_key_formats_s8(spark):
    df = spark.createDataFrame([(202501,), (20250115,), (2025,), (None,)], "m int")
    got = [r.k for r in df.select(month_key(F.col("m")).alias("k")).collect()]
    assert got == [202501, 202501, None, None]
    ends = [r.e for r in df.select(month_end(F.col("m")).alias("e")).collect()]
    assert [str(e) if e else None for e in ends] == ["2025-01-31", "2025-01-31", None, None]


def test_month_keys_without_a_calendar_day(spark):
    df = spark.createDataFrame([("202513",), ("20250230",), ("20250228",), ("20251301",), ("x",), ("2025011",)], "m string")
    got = [(r.k, str(r.e) if r.e else None) for r in df.select(month_key(F.col("m")).alias("k"), month_end(F.col("m")).alias("e")).collect()]
    assert got == [(202513, None), (202502, None), (202502, "2025-02-28"), (202513, None), (None, None), (None, None)]


def test_month_sort_key(spark):
    df = spark.createDataFrame([("2025-03",), ("202502",), ("Unknown",)], "m string")
    assert [r.k for r in df.select(month_sort_key(F.col("m")).alias("k")).collect()] == ["202503", "202502", "Unknown"]


def test_fmt_matches_python_format(spark):
    vals = [0.0, -0.4, 0.5, 1.5, 2.5, 1234.5678, -98765.4321, 1e9 + 0.125, 12.345, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for dec in (0, 1, 2):
        got = [r.s for r in df.select(fmt(F.col("x"), dec).alias("s")).collect()]
        want = [
            "N/A" if v is None or math.isnan(v) or math.isinf(v) else f"{{:,.{dec}f}}".format(v) for v in vals
        ]
        assert got == want


def test_direction_and_safe(spark):
    df = spark.createDataFrame([(1.0,), (-2.0,), (0.0,), (None,), (float("nan"),), (float("inf"),)], "x double")
    rows = df.select(direction(F.col("x")).alias("d"), safe(F.col("x")).alias("s")).collect()
    assert [r.d for r in rows] == ["positive", "negative", "neutral", "unknown", "unknown", "positive"]
    assert [r.s for r in rows] == [1.0, -2.0, 0.0, 0.0, 0.0, 0.0]


def test_to_number_s24(spark):
    df = spark.createDataFrame([("12.5",), ("x",), (None,), ("-3",)], "t string")
    assert [r.n for r in df.select(to_number(F.col("t")).alias("n")).collect()] == [12.5, 0.0, 0.0, -3.0]


def test_exact_sums_do_not_depend_on_partitioning(spark):
    rnd = random.Random(1)
    rows = [(rnd.uniform(-1e6, 1e6),) for _ in range(5000)]
    df = spark.createDataFrame(rows, "x double")
    a = df.repartition(1).agg(rsum("x", exact=True).alias("s"), ravg("x", exact=True).alias("m")).first()
    b = df.repartition(13).agg(rsum("x", exact=True).alias("s"), ravg("x", exact=True).alias("m")).first()
    assert a == b


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.choice([rnd.randint(0, 20), rnd.gauss(0, 5)]))) for g in range(3) for _ in range(300 + 97 * g)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p70": 0.7, "p100": 1.0}
    got = {r.g: r for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in range(3):
        vals = np.array([v for gg, v in rows if gg == g])
        for a, p in probs.items():
            assert getattr(got[g], a) == np.quantile(vals, p), (g, a)
    one = exact_quantiles_of(df, [("v", 0.7, "a"), ("g", 0.5, "b")]).first()
    assert one.a == np.quantile([v for _, v in rows], 0.7)
    assert one.b == np.quantile([g for g, _ in rows], 0.5)


def test_exact_quantiles_of_small_groups(spark):
    """Groups smaller than the bracket: the neighbours beside it are needed."""
    rnd = random.Random(6)
    rows = [(n, float(rnd.randint(0, 6))) for n in range(1, 30) for _ in range(n)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = {f"p{k}": k / 20 for k in range(21)}
    for r in exact_quantiles(df, "v", probs, ["g"], extremes=("lo", "hi")).collect():
        vals = [v for g, v in rows if g == r.g]
        assert (r.lo, r.hi) == (min(vals), max(vals))
        assert all(abs(r[a] - np.quantile(vals, p)) < 1e-12 for a, p in probs.items())


def test_exact_quantiles_of_a_large_group(spark):
    """Far more rows than the sketch keeps: the brackets hold a small part of them."""
    n = 2_000_000
    df = spark.range(0, n).select((F.col("id") % 99_991 * 1.5 + F.col("id") / 1e7).alias("v"))
    got = exact_quantiles(df, "v", {"a": 0.37, "b": 0.5, "c": 0.999}).first()
    i = np.arange(n)
    vals = (i % 99_991) * 1.5 + i / 1e7
    for name, p in (("a", 0.37), ("b", 0.5), ("c", 0.999)):
        assert abs(got[name] - np.quantile(vals, p)) < 1e-9


def test_exact_sums_pass_the_range_of_scaled_longs(spark):
    df = spark.createDataFrame([(9.0e14,)] * 20 + [(0.25,)], "x double")
    assert df.agg(rsum("x", exact=True).alias("s")).first().s == 1.8e16 + 0.25
