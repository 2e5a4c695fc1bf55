"""Exact top-k search by inner product: branch and bound over column blocks.

Vectors are packed into blocks in vertical layout: one row of numbers per
dimension.  A task takes a block of candidates and a block of queries.  For each
query it adds up scores one group of dimensions at a time, the groups in which
the query has most of its mass first.  By Cauchy and Schwarz, the part of a score
that is still missing lies within plus or minus the product of the two remaining
norms; a candidate whose score can no longer reach the k-th best lower bound is
dropped and the survivors are compacted before the next group.

Scores are exact integers.  A query block meets every candidate block, as every
row is a candidate; each pair gives at most k rows per query.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.llm.common import arrow_rows, ship_package, stage

#: Dimensions added between two rounds of pruning.
GROUP = 8
#: float64 holds integers exactly below this.
EXACT = 2.0**52


def usable(vector: str = "embedding") -> Column:
    """Vectors that take part: not null, no null and no non-finite component."""
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return v.isNotNull() & ~F.coalesce(F.exists(v, bad), F.lit(False))


def _pack(rows: DataFrame, size: int, tag: str) -> DataFrame:
    """Rows (vec_id, v) into blocks (block, n, dims, ids, data): ``data`` holds
    ``dims`` rows of ``n`` float64, shorter vectors filled with zeros."""

    def pack(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        cols: list[np.ndarray] = []
        held = 0

        def block(ids, cols):
            nonlocal made
            dims = max((c.shape[0] for c in cols), default=0)
            wide = [np.pad(c, ((0, dims - c.shape[0]), (0, 0))) for c in cols]
            data = np.ascontiguousarray(np.concatenate(wide, axis=1))
            made += 1
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "block": (part << 32) + made,
                        "n": int(data.shape[1]),
                        "dims": dims,
                        "ids": np.concatenate(ids).tobytes(),
                        "data": data.tobytes(),
                    }
                ],
                schema=pa.schema(
                    [("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())]
                ),
            )

        for batch in batches:
            vec = batch.column(1)
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = vec.offsets.to_numpy().astype(np.int64)
            flat = np.floor(256.0 * vec.values.to_numpy(zero_copy_only=False).astype(np.float64))
            lens = np.diff(ends)
            m = np.zeros((int(lens.max(initial=0)), len(own)))
            col = np.repeat(np.arange(len(own)), lens)
            m[np.arange(len(col)) - np.repeat(ends[:-1] - ends[0], lens), col] = flat[ends[0] : ends[-1]]
            for at in range(0, len(own), size):
                ids.append(own[at : at + size])
                cols.append(m[:, at : at + size])
                held += len(ids[-1])
                if held >= size:
                    yield block(ids, cols)
                    ids, cols, held = [], [], 0
        if held:
            yield block(ids, cols)

    packed = rows.mapInArrow(pack, "block long, n int, dims int, ids binary, data binary")
    with arrow_rows(rows.sparkSession, size):
        return stage(packed, tag)


def search_block(
    q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, group: int = GROUP
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The k best candidates of each query: (query position, candidate position,
    score).  ``q`` and ``x`` are (dims, n) arrays of whole numbers; a candidate with
    the query's id is left out; equal scores go to the smaller id."""
    dims = max(q.shape[0], x.shape[0])
    q = np.pad(q, ((0, dims - q.shape[0]), (0, 0)))
    x = np.pad(x, ((0, dims - x.shape[0]), (0, 0)))
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(dims, 1)
    if not most < EXACT:  # products beyond float64: whole Python numbers, every candidate
        return _search_large(q, q_ids, x, x_ids, k)
    groups = [slice(a, min(a + group, dims)) for a in range(0, dims, group)]
    mass = lambda m: np.array([(m[g] * m[g]).sum(0) for g in groups]).reshape(len(groups), m.shape[1])
    q_mass, x_mass = mass(q), mass(x)
    x_total = x_mass.sum(0)
    if not max(q_mass.sum(0).max(initial=0), x_total.max(initial=0)) < EXACT:  # masses are whole numbers too
        return _search_large(q, q_ids, x, x_ids, k)
    at_q: list[np.ndarray] = []
    at_x: list[np.ndarray] = []
    scores: list[int] = []
    for i in range(q.shape[1]):
        alive = np.flatnonzero(x_ids != q_ids[i])
        score = np.zeros(len(alive))
        x_left = x_total[alive]
        q_left = q_mass[:, i].sum()
        for g in np.argsort(-q_mass[:, i], kind="stable"):
            if not q_left:
                break  # the query has nothing left: scores are final
            score += q[groups[g], i] @ x[groups[g]][:, alive]
            x_left = x_left - x_mass[g, alive]
            q_left -= q_mass[g, i]
            if len(alive) > k:
                # the root is rounded: a little wider than it says
                slack = np.sqrt(q_left * x_left) * (1 + 1e-9) + 1
                floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                stay = score + slack >= floor
                if not stay.all():
                    alive, score, x_left = alive[stay], score[stay], x_left[stay]
        best = np.lexsort((x_ids[alive], -score))[:k]
        at_q.append(np.full(len(best), i))
        at_x.append(alive[best])
        scores.extend(int(s) for s in score[best])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(at_q or none), np.concatenate(at_x or none), scores


def _search_large(q, q_ids, x, x_ids, k):
    whole = [[int(v) for v in x[:, j]] for j in range(x.shape[1])]
    at_q, at_x, scores = [], [], []
    for i in range(q.shape[1]):
        own = [int(v) for v in q[:, i]]
        found = [
            (-sum(a * b for a, b in zip(own, whole[j])), int(x_ids[j]), j)
            for j in range(len(whole))
            if x_ids[j] != q_ids[i]
        ]
        for s, _, j in sorted(found)[:k]:
            at_q.append(i)
            at_x.append(j)
            scores.append(max(-(2**63), min(2**63 - 1, -s)))
    return np.array(at_q, np.int64), np.array(at_x, np.int64), scores


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, block: int = 4096, query_block: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query.

    ``vectors`` has vec_id and embedding; a component x counts as floor(256 * x).
    Every usable row is a candidate, rows with the query's own vec_id left out; rows
    for which ``is_query`` is true are queries as well.  Score: integer inner product
    (shorter vectors count as filled with zeros; beyond a long it is cut to its
    range); ties go to the smaller vec_id.  Rows with a null vec_id and unusable
    vectors take no part.  Repeated rows are candidates each; a repeated query row
    gets a result each.  Fewer candidates than ``k``: all of them.  No rows in, no
    rows out.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.where(usable() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    queries = vectors.where(usable() & F.col("vec_id").isNotNull() & is_query).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    x = _pack(rows, block, "topk-candidates")
    q = _pack(queries, query_block, "topk-queries").select(*[F.col(c).alias(f"q_{c}") for c in ("block", "n", "dims", "ids", "data")])

    def search(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                cand = np.frombuffer(r["data"]).reshape(r["dims"], r["n"])
                ask = np.frombuffer(r["q_data"]).reshape(r["q_dims"], r["q_n"])
                ids, q_ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                at_q, at_x, scores = search_block(ask, q_ids, cand, ids, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at_q), r["q_block"], np.int64)),
                        pa.array(at_q.astype(np.int32)),
                        pa.array(q_ids[at_q]),
                        pa.array(ids[at_x]),
                        pa.array(scores, pa.int64()),
                    ],
                    names=["q_block", "q_at", "query_id", "vec_id", "score"],
                )

    # the stated query set, in blocks, against all rows, in blocks
    pairs = x.join(q, how="cross")
    with arrow_rows(spark, 4):
        found = stage(
            pairs.mapInArrow(search, "q_block long, q_at int, query_id long, vec_id long, score long"), "topk-found"
        )
    best = Window.partitionBy("q_block", "q_at").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
