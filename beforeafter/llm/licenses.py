"""License scan: MinHash bands over overlapping windows retrieve templates, exact
shingle containment decides.

A text's words are lower-cased, punctuation removed, and read as five-word
shingles.  Templates are grouped by length into tiers; a tier's windows are as long
as its templates and overlap by at least three quarters.  ``BANDS`` hash functions
give each window and each template a minimum; one equal minimum (bands of one row)
retrieves the template.  A window that holds 80 % of a template's shingles, at the
worst offset, has Jaccard similarity 0.45 or more with it, so it is missed with
probability 0.55^16 < 0.0001, and a copy lies in several windows.  Retrieved
templates are checked against the text's exact shingles.

A window can only share a minimum with a template if it holds one of the templates'
shingles, so texts without any skip the windows.  DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.common import ascii_lower, broadcast_if_small, stage, text_of, words

SHINGLE = 5
BANDS = 16
CONTAINMENT = 0.8
#: Marks that do not count.
PUNCTUATION = ".,;:()[]{}\"'`*#!?<>"


@dataclass(frozen=True)
class Template:
    name: str
    text: str


# Notices by which works state a public license.
TEMPLATES = [
    Template("Apache-2.0 line", "Licensed under the Apache License, Version 2.0."),
    Template("MIT line", "Released under the MIT License."),
    Template("GPL-3.0 line", "This work is licensed under the GNU General Public License, version 3."),
    Template("CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0."),
    Template(
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    Template(
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    Template(
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Template(
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer.",
    ),
]


def license_words(text: Column) -> Column:
    """Words as licenses are compared by: A-Z lower-cased, punctuation removed."""
    return words(F.translate(ascii_lower(text), PUNCTUATION, ""))


def shingle_hashes(w: str) -> Column:
    """64-bit hash of each five-word shingle of the array column ``w`` (none if
    there are fewer words)."""
    parts = lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(SHINGLE)])
    return F.when(
        F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), parts)
    ).otherwise(F.array().cast("array<bigint>"))


def _minimum(hashes: Column, band: int) -> Column:
    """Minimum of a window under hash function ``band``."""
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(F.lit(band), h)))


def template_rows(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """(license, shingles, n, tier): distinct shingle hashes of each template; a
    tier holds templates whose number of shingles has the same power of two below."""
    spark = docs.sparkSession
    rows = spark.createDataFrame([(t.name, t.text) for t in templates], "license string, text string")
    rows = rows.select("license", license_words(F.col("text")).alias("w"))
    rows = rows.select("license", F.array_distinct(shingle_hashes("w")).alias("shingles"))
    rows = rows.withColumn("n", F.size("shingles"))
    return rows.where("n > 0").withColumn("tier", F.floor(F.log2("n")).cast("int"))


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, least: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, n_shared, n_template, containment): every template of
    which a text holds at least ``least`` of the distinct five-word shingles.

    ``docs`` has doc_id and text; other columns are not read.  Null and empty texts
    and texts of under five words hold none; a template of under five words is never
    found.  Repeated rows give repeated results; a row without a doc_id is scanned
    like any other.  No rows in, no rows out.
    """
    known = stage(template_rows(docs, templates if templates is not None else TEMPLATES), "license-templates")
    # bounded by the list of templates, not by the data
    table = known.collect()
    everything = sorted({h for r in table for h in r["shingles"]})
    schema = docs.select("doc_id")
    if not everything:
        return schema.where(F.lit(False)).select(
            "doc_id",
            F.lit("").alias("license"),
            F.lit(0).cast("long").alias("n_shared"),
            F.lit(0).cast("long").alias("n_template"),
            F.lit(0.0).alias("containment"),
        )
    split = docs.select("doc_id", license_words(text_of("text")).alias("w"))
    hashed = split.select("doc_id", shingle_hashes("w").alias("sh"), F.spark_partition_id().alias("_part"))
    # _part keeps the filter above the arrays: it would otherwise compute them twice
    screened = hashed.where(F.arrays_overlap("sh", F.lit(everything).cast("array<bigint>")) & (F.col("_part") >= 0))
    screened = stage(screened.select(F.monotonically_increasing_id().alias("row"), "doc_id", "sh"), "license-screened")
    found = None
    for tier in sorted({r["tier"] for r in table}):
        long = max(r["n"] for r in table if r["tier"] == tier)
        step = max(1, long // 8)
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("sh") - long + 1 + step), F.lit(step))
        window = screened.select("row", "sh", F.explode(starts).alias("at")).select(
            "row", F.slice("sh", F.col("at"), F.lit(long)).alias("sh")
        )
        # only windows with a template's shingle can share a minimum with one
        own = sorted({h for r in table if r["tier"] == tier for h in r["shingles"]})
        window = window.where(F.arrays_overlap("sh", F.lit(own).cast("array<bigint>")))
        keys = lambda c: F.explode(
            F.array(*[F.struct(F.lit(b).alias("band"), _minimum(c, b).alias("least")) for b in range(BANDS)])
        ).alias("key")
        bands = known.where(F.col("tier") == tier).select("license", keys(F.col("shingles")))
        hit = (
            window.select("row", keys(F.col("sh")))
            .select("row", "key.band", "key.least")
            .distinct()
            .join(F.broadcast(bands.select("license", "key.band", "key.least")), ["band", "least"])
            .select("row", "license")
        )
        found = hit if found is None else found.unionByName(hit)
    candidates = found.distinct()
    # exact: distinct shingles of the template that the text holds
    shared = F.size(F.array_intersect("shingles", "sh"))
    checked = (
        candidates.join(F.broadcast(known), "license")
        .join(screened, "row")
        .withColumn("n_shared", shared.cast("long"))
        .withColumn("containment", F.col("n_shared") / F.col("n"))
        .where(F.col("containment") >= least)
    )
    return checked.select("doc_id", "license", "n_shared", F.col("n").cast("long").alias("n_template"), "containment")
