"""Exact top-k inner-product search by columnar branch-and-bound.

Vectors are quantised to ``floor(256 * x)``.  Queries and candidates form a
grid: groups of at most ``QUERY_GROUP`` queries meet groups of at most
``CANDIDATE_GROUP`` candidates, one grid cell at a time, so a task holds a
bounded number of vectors however many there are.  Within a cell candidates
lie dimension by dimension (vertical layout).  Inner products are accumulated
block of dimensions by block; after each block a candidate whose partial
score plus the Cauchy-Schwarz bound of the remaining masses can't reach the
query's k-th best score is dropped, and the survivors are compacted.  Each
cell yields at most k rows per query; the best k of those are the result.

Scores are exact: whole numbers below 2^53 in float64, Python integers when
the components are larger.  The bound is widened by a relative 1e-9, so
rounding never drops a candidate, and equal scores are never dropped.

Defined cases: vectors that are null, empty or hold a null or a non-finite
component take no part, nor do rows with a null id; of vectors of different
lengths the shorter one counts as padded with zeros; rows with the query's id
aren't its candidates; repeated candidate rows count once each (they travel as
one row with a count); of several query rows with one id the smallest vector
asks; a score that doesn't fit 64 bits raises an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_GROUP = 2048
CANDIDATE_GROUP = 16384
CHUNK = 2048  # candidates scored together
BLOCK = 16  # dimensions accumulated between two prunings
SCALE = 256


def valid_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and the components as doubles; invalid vectors left out.  Tasks
    take floor(256 * x) when they build their matrices."""
    x = F.transform(F.col(f"`{embedding}`"), lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).where(ok))


def _matrix(rows: pd.DataFrame, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for i, v in enumerate(rows["x"]):
        out[i, :len(v)] = v
    return np.floor(out * SCALE)


def _norms_left(m: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Euclidean norm of what lies from each cut on: (cuts, rows)."""
    return np.stack([np.sqrt((m[:, c:] ** 2).sum(axis=1)) for c in cuts])


def _exact(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores as Python integers, for components beyond float64's range."""
    score = np.array([sum(int(a) * int(b) for a, b in zip(q, row, strict=True)) for row in m], dtype=object)
    if len(score) and (max(score) >= 2 ** 63 or min(score) < -2 ** 63):
        raise OverflowError("a score doesn't fit 64 bits")
    return score


class _Best:
    """The k best (score, vec_id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0), np.zeros(0, np.int64)

    def floor(self) -> float:
        return self.score[self.k - 1] if len(self.score) >= self.k else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.ids = score[order], ids[order]


def search_cell(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """The k best candidates of each query within one grid cell: lists of
    query ids, candidate ids, scores."""
    dims = q.shape[1]
    most = max(np.abs(q).max(initial=0), np.abs(c).max(initial=0))
    big = most * most * dims >= 2 ** 53
    out_q, out_c, out_s = [], [], []
    if big:
        for i in range(len(qid)):
            other = np.flatnonzero(cid != qid[i])
            score = _exact(q[i], c[other])
            for j in sorted(range(len(other)), key=lambda j: (-score[j], cid[other[j]]))[:k]:
                out_q.append(int(qid[i])), out_c.append(int(cid[other[j]])), out_s.append(int(score[j]))
        return out_q, out_c, out_s
    # dimensions in order of falling mass, so that bounds tighten early
    order = np.argsort(-((c ** 2).sum(axis=0)))
    q, c = q[:, order], c[:, order]
    cuts = list(range(0, dims, BLOCK))[1:]
    blocks = list(zip([0, *cuts], [*cuts, dims], strict=True))
    q_left = _norms_left(q, cuts) if cuts else None
    best = [_Best(k) for _ in qid]
    # candidates with the largest norms first: they raise the k-th best score soon
    rank = np.argsort(-(c ** 2).sum(axis=1), kind="stable")
    cid, c = cid[rank], c[rank]
    for at in range(0, len(cid), CHUNK):
        ids, part = cid[at:at + CHUNK], c[at:at + CHUNK]
        columns = [np.ascontiguousarray(part[:, a:b]) for a, b in blocks]  # vertical layout, by block of dimensions
        c_left = _norms_left(part, cuts) if cuts else None
        first = q[:, blocks[0][0]:blocks[0][1]] @ columns[0].T
        for i in range(len(qid)):
            floor = best[i].floor()
            live, score = np.flatnonzero(ids != qid[i]), None
            score = first[i][live]
            for n, (a, b) in enumerate(blocks):
                if n:
                    score = score + columns[n][live] @ q[i, a:b]
                if n < len(cuts) and floor > -np.inf:
                    bound = q_left[n, i] * c_left[n][live]
                    stays = score + bound * (1 + 1e-9) + 1e-6 >= floor
                    live, score = live[stays], score[stays]
                    if not len(live):
                        break
            if len(live):
                best[i].add(score, ids[live])
    for i, b in enumerate(best):
        out_q += [int(qid[i])] * len(b.ids)
        out_c += b.ids.tolist()
        out_s += [int(s) for s in b.score]
    return out_q, out_c, out_s


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products
    of every row of ``queries`` over ``vectors``, ties to the smaller id."""
    base, asked = valid_vectors(vectors, vec_id, embedding), valid_vectors(queries, vec_id, embedding)
    base = base.groupBy("vec_id", "x").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    asked = asked.groupBy("vec_id").agg(F.min("x").alias("x"))
    size = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    asked_size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    dims = max(size["d"] or 0, asked_size["d"] or 0)
    n_c = max(1, math.ceil(size["n"] / CANDIDATE_GROUP))
    n_q = max(1, math.ceil(asked_size["n"] / QUERY_GROUP))
    # every query group meets every candidate group: replicate each side along the other's axis
    salt = F.xxhash64("vec_id", "x")
    c = base.select("vec_id", "x", "copies", F.pmod(salt, F.lit(n_c)).alias("cg")).withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    q = asked.select("vec_id", "x", F.pmod(salt, F.lit(n_q)).alias("qg")).withColumn("cg", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    cols = ["query_id", "vec_id", "score"]

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({x: np.zeros(0, np.int64) for x in cols})
        right = right.loc[right.index.repeat(right["copies"])]  # at most k rows of each
        a, b, s = search_cell(left["vec_id"].to_numpy(np.int64), _matrix(left, dims),
                              right["vec_id"].to_numpy(np.int64), _matrix(right, dims), k)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": s}).astype(np.int64)

    found = (q.select("qg", F.col("cg").cast("bigint").alias("cg"), "vec_id", "x")
             .groupBy("qg", "cg")
             .cogroup(c.select("cg", F.col("qg").cast("bigint").alias("qg"), "vec_id", "x", "copies").groupBy("qg", "cg"))
             .applyInPandas(cell, "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def topk_sql(k: int = 5, every: int = 50, source: str = "embeddings") -> str:
    """DuckDB SQL of the query over ``source`` (finite vectors of one length)."""
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM {source}
           WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
