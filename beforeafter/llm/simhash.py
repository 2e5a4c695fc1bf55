"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last padded
with zeros).  The binary Golay code of length 23 is perfect: every 23-bit word
lies within 3 bits of exactly one of 4096 codewords.  The *keys* of a segment are
the indices of all codewords within 4 bits of it (1 or 6 of them), and two
segments that differ in at most 2 bits always share a key.

Pigeonhole for at most 4 differing bits over three segments: either one segment
is equal and another one differs in at most 2 bits, or none is equal and each
differs in 1 or 2.  So two fingerprints within 4 bits always meet under

* (equal segment, Golay key of another segment): six choices, or
* (Golay key of each of the three segments).

Fingerprints that share such a key are verified bit by bit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.llm.common import arrow_rows, broadcast_if_small, ship_package, shuffle_parts, stage
from beforeafter.llm.components import connected_components, join_hubs

#: Largest distance that the key scheme below guarantees to find.
MAX_BITS = 4
#: Most keys of one fingerprint.
KEYS = 6 * 6 + 6**3

# --------------------------------------------------------------------------
# Golay code, built from its generator polynomial
# --------------------------------------------------------------------------

#: Fixed value: generator polynomial of the binary Golay code,
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parity of each 12-bit index; for each of the 2048 syndromes the error
    patterns of at most 4 bits (up to 6) and how many there are."""
    unit = [_remainder(1 << b) for b in range(23)]
    parity = np.array([_remainder(i << 11) for i in range(4096)], np.uint32)
    errors: list[list[int]] = [[] for _ in range(2048)]

    def add(start: int, word: int, syndrome: int, weight: int) -> None:
        errors[syndrome].append(word)
        if weight < 4:
            for b in range(start, 23):
                add(b + 1, word | 1 << b, syndrome ^ unit[b], weight + 1)

    add(0, 0, 0, 0)
    pattern = np.zeros((2048, 6), np.uint32)
    count = np.zeros(2048, np.int64)
    for s, e in enumerate(errors):
        count[s] = len(e)
        pattern[s, : len(e)] = e
    return parity, pattern, count


_CODE: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices within 4 bits of each 23-bit word: an array (n, 6) and
    the number of valid entries (1 or 6) in each row."""
    if not _CODE:
        _CODE.append(_tables())
    parity, pattern, count = _CODE[0]
    words = words.astype(np.uint32)
    syndrome = parity[words >> 11] ^ (words & 0x7FF)
    return (words[:, None] ^ pattern[syndrome]) >> 11, count[syndrome]


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows of the fingerprints, as two arrays."""
    exact = [fps >> np.uint64(41), fps >> np.uint64(18) & np.uint64(0x7FFFFF), fps & np.uint64(0x3FFFF)]
    near, valid = zip(*(golay_keys(s) for s in exact))
    slots = np.arange(6)
    ok = [slots < v[:, None] for v in valid]
    keys, rows = [], []
    at = np.arange(len(fps))

    def put(kind: int, key: np.ndarray, use: np.ndarray) -> None:
        use = use.reshape(len(fps), -1)
        keys.append((key.reshape(len(fps), -1) | np.uint64(kind << 60))[use])
        rows.append(np.repeat(at, use.sum(1)))

    kind = 0
    for a in range(3):
        for b in range(3):
            if a != b:
                put(kind, exact[a][:, None] << np.uint64(12) | near[b].astype(np.uint64), ok[b])
                kind += 1
    k = [n.astype(np.uint64) for n in near]
    triple = (
        k[0][:, :, None, None] << np.uint64(24) | k[1][:, None, :, None] << np.uint64(12) | k[2][:, None, None, :]
    )
    put(kind, triple, ok[0][:, :, None, None] & ok[1][:, None, :, None] & ok[2][:, None, None, :])
    return np.concatenate(keys), fps[np.concatenate(rows)]


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(32)


# --------------------------------------------------------------------------
# Fingerprints
# --------------------------------------------------------------------------


def simhash_text(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text: lower-cased A-Z, ASCII-space words, XXH64 of
    the space-joined shingles; a bit is set if over half of the hashes set it.
    Long texts are taken in blocks."""
    from xxhash import xxh64_intdigest

    ws = text.lower().split()  # bytes: ASCII only
    if not ws:
        return 0
    n = max(1, len(ws) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 100_000):
        here = ws[at : at + 100_000 + shingle - 1]
        parts = [here[k : len(here) - shingle + 1 + k] for k in range(shingle)] if n > 1 or len(ws) == shingle else None
        grams = map(b" ".join, zip(*parts)) if parts else [b" ".join(ws)]
        h = np.fromiter([xxh64_intdigest(g, seed) for g in grams], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, beside: str = "doc_id") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, fp the fingerprint as a signed
    long.  Null and empty texts have fingerprint zero; only doc_id (or the column
    named by ``beside``) and text are read."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField(beside, docs.schema[beside].dataType), T.StructField("fp", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = [simhash_text(t.as_py() or b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=[beside, "fp"]
            )

    return docs.select(beside, "text").mapInArrow(run, schema)


# --------------------------------------------------------------------------
# Links
# --------------------------------------------------------------------------


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def verified_links(keys: np.ndarray, fps: np.ndarray, max_bits: int, wide: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest one of its group) that the rows prove.

    Rows that share a key are compared.  Runs of up to ``wide`` rows are compared
    shifted against themselves, all runs at once; in a longer run groups are grown
    by breadth-first search, each step comparing a fingerprint with those not
    reached yet, so a dense run of n costs about n comparisons times its number of
    groups and never n^2 output rows.
    """
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    same = np.empty(len(keys), bool)
    same[:1] = True
    same[1:] = (keys[1:] != keys[:-1]) | (fps[1:] != fps[:-1])
    keys, fps = keys[same], fps[same]
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    length = np.diff(np.r_[begin, len(keys)])
    ends: list[np.ndarray] = []
    other: list[np.ndarray] = []
    short = np.repeat((length > 1) & (length <= wide), length)
    k, f = keys[short], fps[short]
    for shift in range(1, wide):
        if shift >= len(k):
            break
        hit = (k[shift:] == k[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= max_bits)
        ends.append(f[shift:][hit])
        other.append(f[:-shift][hit])
    for r in np.flatnonzero(length > wide):
        rest = fps[begin[r] : begin[r] + length[r]]
        while len(rest) > 1:
            seed, rest = rest[0], rest[1:]
            todo = [seed]
            while todo and len(rest):
                near = np.bitwise_count(rest ^ todo.pop()) <= max_bits
                if near.any():
                    new = rest[near]
                    rest = rest[~near]
                    todo.extend(new)
                    ends.append(new)
                    other.append(np.full(len(new), seed))
    if not ends:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = np.concatenate(ends), np.concatenate(other)
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = _roots(len(nodes), index[: len(a)], index[len(a) :])
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all
    fingerprints within ``max_bits`` of each other: in every slice of the key space
    a spanning forest, not all pairs.

    Keys travel packed, one binary row per slice and Arrow batch.  The number of
    slices follows the number of keys, so a slice has about a million rows.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the key scheme is complete up to {MAX_BITS} bits")
    spark = fps.sparkSession
    ship_package(spark)
    n = fps.count()
    parts = max(shuffle_parts(spark), -(-n * KEYS // 1_500_000))
    slices = 8 * parts

    def spread(batches):
        import pyarrow as pa

        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(own), 4096):
                keys, vals = fuzzy_keys(own[at : at + 4096])
                to = (_scatter(keys) % np.uint64(slices)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                keys, vals, to = keys[order], vals[order], to[order]
                cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                stop = np.r_[cut[1:], len(to)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to[cut].astype(np.int32)),
                        pa.array([keys[i:j].tobytes() for i, j in zip(cut, stop)], pa.binary()),
                        pa.array([vals[i:j].tobytes() for i, j in zip(cut, stop)], pa.binary()),
                    ],
                    names=["slice", "keys", "fps"],
                )

    def verify(batches):
        import pyarrow as pa

        keys, vals = [], []
        for batch in batches:
            keys.append(b"".join(x.as_py() for x in batch.column(1)))
            vals.append(b"".join(x.as_py() for x in batch.column(2)))
        a, b = verified_links(
            np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(vals), np.uint64), max_bits
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    return (
        fps.select("fp")
        .mapInArrow(spread, "slice int, keys binary, fps binary")
        .repartition(parts, "slice")
        .mapInArrow(verify, "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, seed: int = 42, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is the
    smallest doc_id reachable over links, the document's own included.  Equal
    fingerprints, also those of null or empty texts (zero), are one node, so a
    group of copies costs one row in the search.  A row with a null doc_id takes
    part; its component_id is null if nothing it reaches has a doc_id.  No rows
    in, no rows out.
    """
    own, groups = _grouped(docs, shingle, seed, max_bits)
    return join_hubs(own, groups.drop("root"), "fp", own.count()).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, shingle: int, seed: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, stored, and (fp, component_id, root, n) of every
    fingerprint: root tells components apart, n counts the fingerprint's rows."""
    with arrow_rows(docs.sparkSession, 1000):
        own = stage(fingerprints(docs, shingle, seed), "simhash-docs")
    nodes = stage(own.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    with arrow_rows(docs.sparkSession, 4096):
        links = stage(fingerprint_links(nodes.drop("n"), max_bits), "simhash-links")
    # null-safe only in name: fp is never null
    found = connected_components(links).select(F.col("node").alias("fp"), "root")
    rooted = stage(nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    groups = join_hubs(rooted.withColumnRenamed("n", "copies"), least, "root", rooted.count())
    return own, groups.select("fp", "component_id", "root", F.col("copies").alias("n"))


def hex_fingerprint(fp: str = "fp"):
    """16 lowercase hexadecimal digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = 4, seed: int = 42, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate component, with its columns: that of the smallest
    doc_id, a row without doc_id where no other is in the component.

    A doc_id that stands on one row decides by itself, so texts meet only a list of
    doc_ids.  Rows whose doc_id repeats or is null are told apart by their text: their
    fingerprint is read once more and brings the component, in which one row of the
    smallest doc_id stays (of these the one with the smallest fingerprint and hash of
    the text; equal rows are one as good as the other)."""
    spark = docs.sparkSession
    own, groups = _grouped(docs, shingle, seed, max_bits)
    groups = stage(groups, "simhash-groups")
    placed = join_hubs(own, groups.drop("root"), "fp", own.count()).where("doc_id IS NOT NULL")
    per = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("least"))
    out = stage(per.where("n > 1 OR doc_id != least").select("doc_id", (F.col("n") > 1).alias("again")), "simhash-losers")
    alone = docs.join(broadcast_if_small(out.select("doc_id")), "doc_id", "left_anti").where("doc_id IS NOT NULL")
    repeated = docs.join(broadcast_if_small(out.where("again").select("doc_id")), "doc_id", "left_semi")
    unclear = repeated.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
    with arrow_rows(spark, 1000):
        unclear = unclear.select("text", F.struct(*docs.columns).alias("row"))
        unclear = stage(fingerprints(unclear, shingle, seed, "row"), "simhash-unclear")
    met = join_hubs(unclear, groups, "fp", own.count()).where("row.doc_id <=> component_id")
    # the first row per root is taken before the shuffle too, so a hot doc_id is not gathered
    first = Window.partitionBy("root").orderBy("fp", F.xxhash64("row.text"))
    chosen = met.withColumn("__rank", F.row_number().over(first)).where("__rank = 1").select("row.*")
    return alone.select(*docs.columns).unionByName(chosen)
