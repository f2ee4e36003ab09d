"""Exact top-k search by inner product in three phases with a uniform threshold.

The components are cut into `SLICES` slices; a vector's score is the sum of its partial scores. In the first phase
every task gathers, per query, the vectors with the highest partial scores of each slice and their whole scores; the
k-th highest of all gathered is a safe cutoff, as at least k vectors reach it. It is broadcast. A vector that reaches
the cutoff has, in one slice at least, a partial score of the cutoff's uniform share, so the second phase collects
those entries only, and the third resolves their remaining scores exactly and keeps the k best.

Queries are taken in blocks, each against all vectors; a block of at most about `QUERY_BLOCK` vectors and its cutoffs
pass through the driver. Scores are sums of integers and exact below 2**53.

Defined results: vectors that are null or hold null or non-finite components, and rows without an id, take no part. A
query meets vectors of its own number of components, except rows with its own id. Ties go to the smaller id; rows that
repeat an id count each. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import materialize

K = 20
SCALE = 64
SLICES = 4
LOCAL = 4  # entries of each slice and query that a task gathers per chunk
QUERY_BLOCK = 2048
ROWS = 1024  # vectors multiplied at once


def _arrays(batch: pa.RecordBatch):
    """Ids and integer vectors of a batch, by number of components."""
    ids, vectors = batch.column(0), batch.column(1)
    given = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    if not given.any():
        return
    batch = batch.filter(pa.array(given))
    ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    firsts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        for part in np.array_split(rows, -(-len(rows) // ROWS)):
            x = np.floor(SCALE * flat[firsts[part][:, None] + np.arange(n)])
            fine = np.isfinite(x).all(axis=1)
            if fine.any():
                yield int(n), ids[part][fine], x[fine]


def _partial(queries: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """Partial scores per slice: a row per query, a column per vector."""
    return [queries[:, s] @ x[:, s].T for s in np.array_split(np.arange(x.shape[1]), min(SLICES, x.shape[1]))]


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[keep], ids[keep], score[keep]


def _scan(vectors: DataFrame, held, k: int, gather) -> DataFrame:
    """Runs `gather` on every chunk of vectors of every task; one task gives at most k rows per query."""

    def apply(batches):
        best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64))
        for batch in batches:
            for n, ids, x in _arrays(batch):
                for names, queries, cutoffs in held.value.get(n, []):
                    q, at, score = gather(names, ids, _partial(queries, x), cutoffs)
                    if len(q):
                        best = _best(*(np.concatenate(p) for p in zip(best, (names[q], ids[at], score), strict=True)), k)
        if len(best[0]):
            yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(best[1]), pa.array(best[2].astype(np.int64))], names=["query_id", "vec_id", "score"])

    return vectors.mapInArrow(apply, "query_id long, vec_id long, score long")


def _highest_slices(names, ids, parts, cutoffs):
    """First phase: the vectors with the highest partial scores, and their whole scores."""
    total = sum(parts)
    chosen = np.zeros(total.shape, bool)
    most = min(LOCAL, total.shape[1])
    for part in parts:
        np.put_along_axis(chosen, np.argpartition(part, -most, axis=1)[:, -most:], True, axis=1)
    q, at = np.nonzero(chosen & (names[:, None] != ids[None, :]))
    return q, at, total[q, at]


def _above_share(names, ids, parts, cutoffs):
    """Second and third phase: entries that reach the uniform share in a slice, if their whole score reaches the cutoff."""
    share = (cutoffs / len(parts))[:, None]
    chosen = parts[0] >= share
    for part in parts[1:]:
        chosen |= part >= share
    q, at = np.nonzero(chosen & (names[:, None] != ids[None, :]))
    score = sum(part[q, at] for part in parts)
    keep = score >= cutoffs[q]
    return q[keep], at[keep], score[keep]


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank from 1, vec_id and score of the k best vectors of each query."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = vectors.where(is_query).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    # a repeated id with different vectors asks once per vector; its answers are then ranked together
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()  # one block: bounded
        queries: dict[int, list] = {}
        for batch in own.to_batches():
            for n, ids, x in _arrays(batch):
                queries.setdefault(n, []).append((ids.astype(np.int64), x, np.full(len(ids), -np.inf)))
        if not queries:
            continue
        held = spark.sparkContext.broadcast(queries)
        first = _ranked(_scan(rows, held, k, _highest_slices).select("query_id", "vec_id", "score"), k)
        cut = {r.query_id: float(r.score) for r in first.where(F.col("rank") == k).select("query_id", "score").collect()}
        bounded = {n: [(ids, x, np.array([cut.get(int(i), -np.inf) for i in ids])) for ids, x, _ in group] for n, group in queries.items()}
        held = spark.sparkContext.broadcast(bounded)
        last = materialize(_ranked(_scan(rows, held, k, _above_share), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "top-k")
        found = last if found is None else found.union(last)
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
