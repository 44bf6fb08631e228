"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks. A block's task sorts its rows once along each
dimension. A query walks all lists at once, from the end its component's sign
favours, scores every row it meets for the first time in full, and stops when
the sum of the list values at its depth, a bound for all rows not yet met, is
below the k-th score found, or no row is left to meet. TOGETHER queries walk
side by side, so that rows are scored by products of matrices. Per-block results are merged per query. The work
is cut in blocks on both sides; only k rows a query and block are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERIES, SCALE, K = 16_384, 2_048, 1024, 10
#: Queries of a task that walk the lists side by side and share the scoring of the rows they meet.
TOGETHER = 64


def _block_topk(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query, candidate, score) of the k best of one block for each query."""
    by_id = np.argsort(ids, kind="stable")
    ids, rows = ids[by_id], rows[by_id]
    upward = np.argsort(rows.T, axis=1, kind="stable")
    lists = np.stack([upward, upward[:, ::-1]])
    out = []
    for first in range(0, len(queries), TOGETHER):
        group = slice(first, first + TOGETHER)
        out += _walk(ids, rows, lists, query_ids[group], queries[group], k)
    return out


def _walk(ids: np.ndarray, rows: np.ndarray, lists: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """The threshold algorithm for a few queries; `lists` has each dimension's rows, ascending and descending."""
    many, n = len(queries), len(rows)
    met, before = np.zeros((many, n), dtype=bool), np.zeros((many, n), dtype=bool)
    scored, scores = np.zeros(n, dtype=bool), np.empty((many, n))
    used = [np.flatnonzero(q) for q in queries]
    ends = [(q[dims] > 0).astype(np.intp) for q, dims in zip(queries, used)]
    best = [np.zeros(0, dtype=np.intp)] * many
    walking = list(range(many))
    depth, width = 0, 2
    while walking and depth < n:
        last = min(depth + width, n) - 1
        for g in walking:
            # A query without a component to walk along meets all rows at once.
            met[g, lists[ends[g], used[g], depth : last + 1] if len(used[g]) else slice(None)] = True
        # A row is scored for all queries of the group when the first of them meets it.
        new = np.flatnonzero(met[walking].any(axis=0) & ~scored)
        scored[new] = True
        scores[:, new] = queries @ rows[new].T
        following = []
        for g in walking:
            fresh = np.flatnonzero(met[g] & ~before[g])
            before[g] = met[g]
            if len(best[g]) == k:
                fresh = fresh[scores[g, fresh] >= scores[g, best[g][-1]]]
            fresh = np.concatenate([best[g], fresh[ids[fresh] != query_ids[g]]])
            best[g] = fresh[np.lexsort((ids[fresh], -scores[g, fresh]))[:k]]
            bound = rows[lists[ends[g], used[g], last], used[g]] @ queries[g, used[g]]
            if not met[g].all() and not (len(best[g]) == k and scores[g, best[g][-1]] > bound):
                following.append(g)
        walking = following
        depth, width = depth + width, width * 2
    return [(int(query_ids[g]), int(ids[i]), int(scores[g, i])) for g in range(many) for i in best[g]]


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, q array<long>): floor(scale * x) of rows without null or non-finite components."""
    sound = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(sound & F.col("vec_id").isNotNull()).select("vec_id", whole.alias("q"))


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of each query, ties to the smaller vec_id.

    Both sides have (vec_id, q). A query's own id is no candidate; vectors of
    another dimension are none either. Sums must stay below 2^53. Repeated ids
    are candidates each. Fewer candidates than k give fewer rows, empty sides none.
    """
    blocks = max(1, -(-candidates.count() // BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERIES))
    left = candidates.withColumn("_d", F.size("q")).withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    left = left.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("_d", F.size("q")).withColumn("_part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    right = right.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            found = []
        else:
            found = _block_topk(
                rows["vec_id"].to_numpy(), np.stack(rows["q"]).astype(float), asked["vec_id"].to_numpy(), np.stack(asked["q"]).astype(float), k
            )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["_d", "_block", "_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
