"""Exact top-k search by exhaustive term-at-a-time accumulation.

A block of rows is turned into postings: for every term (dimension) the rows where it isn't zero, with their weights. Each
term of the sparse query rows scatters its weighted postings into a dense array of scores, one column for each
query; a partition selection keeps the best k of a column, and the blocks' results are merged. Nothing is skipped.

Weights are floor(64 * component). Scores are 64-bit integers (32-bit inside a block where no sum can exceed them).

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do null vec_ids; of repeated vec_ids the
smallest vector counts; shorter vectors are filled with zeros; a row is never its own candidate; ties go to the smaller
vec_id; fewer candidates than k give all of them; an empty table gives no rows; other columns are ignored. Components beyond
2**62 are cut there, and sums wrap as 64-bit numbers do.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .blocks import matrix, same_width, top_of, usable

#: The rows of ``top_k`` over ``embeddings`` for the queries whose vec_id is divisible by 20, in DuckDB.
SQL = """with v as (select vec_id, min(embedding::double[]) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 group by vec_id),
w as (select vec_id, list_transform(v, lambda x: floor(64 * x)::bigint) as w from v),
s as (select q.vec_id as query_id, r.vec_id, coalesce(list_sum(list_transform(list_zip(q.w, r.w), lambda p: p[1] * p[2])), 0)::bigint as score from w q join w r on q.vec_id % 20 = 0 and q.vec_id != r.vec_id),
k as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from k where rank <= 20"""


def weights(v: np.ndarray, scale: float = 64.0) -> np.ndarray:
    return np.clip(np.floor(scale * v), -(2.0**62), 2.0**62).astype(np.int64)


def postings(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, weights) of each term."""
    return [(at := np.flatnonzero(rows[:, t]), rows[at, t]) for t in range(rows.shape[1])]


def accumulate(queries: np.ndarray, terms: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores, one row for each of n rows and one column for each query."""
    scores = np.zeros((n, len(queries)), queries.dtype)
    for t, (at, w) in enumerate(terms):
        q = queries[:, t]
        some = np.flatnonzero(q)
        if not len(at) or not len(some):
            continue
        if len(some) * 2 > len(q):
            scores[at] += np.multiply.outer(w, q)
        else:
            scores[np.ix_(at, some)] += np.multiply.outer(w, q[some])
    return scores


def select(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """For each column the best k rows but its own: (column, row), found by partition and sorted within."""
    out_q, out_r = [], []
    for j in range(scores.shape[1]):
        s = scores[:, j]
        at = np.flatnonzero(ids != own[j])
        if len(at) > k:
            s_at = s[at]
            at = at[s_at >= np.partition(s_at, len(at) - k)[len(at) - k]]
        at = at[np.lexsort((ids[at], -s[at]))][:k]
        out_q.append(np.full(len(at), j))
        out_r.append(at)
    return np.concatenate(out_q), np.concatenate(out_r)


def search_block(queries, rows, k: int, width: int = 64):
    import pyarrow as pa

    if not queries.num_rows or not rows.num_rows:
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    q, r = same_width(weights(matrix(queries["v"])), weights(matrix(rows["v"])))
    own, ids = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
    most = (np.abs(q).max(axis=0).astype(float) * np.abs(r).max(axis=0)).sum()
    if most < 2**31:
        q, r = q.astype(np.int32), r.astype(np.int32)
    terms = postings(r)
    a, b, c = [], [], []
    for i in range(0, len(q), width):
        scores = accumulate(q[i : i + width], terms, len(r))
        j, at = select(scores, ids, own[i : i + width], k)
        a.append(own[i + j])
        b.append(ids[at])
        c.append(scores[at, j].astype(np.int64))
    return pa.table({"query_id": np.concatenate(a), "vec_id": np.concatenate(b), "score": np.concatenate(c)})


def top_k(rows: DataFrame, queries, *, k: int = 20, row_block: int = 8192, query_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``rows`` (vec_id, embedding) that fit the condition ``queries``."""
    return top_of(usable(rows, zero=True), queries, lambda q, r: search_block(q, r, k), "long", k, row_block, query_block)
