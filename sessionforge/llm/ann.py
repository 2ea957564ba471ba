"""Approximate nearest neighbours with a hash-prefix forest.

Every vector gets, in each tree, a long string of sign bits of random projections; a tree is the sorted array of these strings. A query
descends every tree to its longest matching prefix (two binary searches a length), then all trees ascend
together, one bit at a time, until enough different candidates share the prefix length in some tree. Candidates are scored
exactly, in double precision, on the original vectors.

Inner products become angles by one more coordinate, sqrt(M^2 - |x|^2) with M the longest vector of the block, so that
the largest inner product is the smallest angle.

Each block of rows has a forest of its own, and every row is indexed. How many candidates are enough is measured in each block: the
smallest share of the block with which ``sample`` of its queries reach ``recall`` against brute force. On vectors with
structure that is a small share, on noise a large one.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part, nor do null vec_ids; of repeated vec_ids
the smallest vector counts; shorter vectors are filled with zeros; a row is never its own candidate; ties go to the
smaller vec_id; fewer candidates than k give all of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .blocks import matrix, same_width, top_of, usable

SHARES = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 3 / 16, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 1.0)


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = 48, bits: int = 48, seed: int = 7):
        rng = np.random.default_rng(seed)
        norms = np.sqrt((vectors**2).sum(axis=1))
        self.vectors, self.trees, self.bits = vectors, trees, bits
        self.planes = rng.standard_normal((vectors.shape[1] + 1, trees * bits)).astype(np.float32)
        more = np.sqrt(np.maximum(norms.max(initial=0.0) ** 2 - norms**2, 0))
        keys = self.strings(np.column_stack([vectors, more]))
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=0)

    def strings(self, extended: np.ndarray) -> np.ndarray:
        """The bit strings of each row in each tree, as numbers whose first bit is the highest."""
        powers = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        out = np.empty((len(extended), self.trees), np.uint64)
        extended = (extended / max(np.abs(extended).max(initial=0.0), 1e-300)).astype(np.float32)
        for t in range(self.trees):
            out[:, t] = ((extended @ self.planes[:, t * self.bits : (t + 1) * self.bits]) > 0) @ powers
        return out

    def ranges(self, queries: np.ndarray):
        """(low, high)[prefix length, query, tree]: where each tree holds the strings that share so long a prefix."""
        q = self.strings(np.column_stack([queries, np.zeros(len(queries))]))
        low = np.empty((self.bits + 1, len(q), self.trees), np.int32)
        high = np.empty_like(low)
        for t in range(self.trees):
            for x in range(self.bits + 1):
                rest = np.uint64(self.bits - x)
                prefix = q[:, t] >> rest
                low[x, :, t] = np.searchsorted(self.keys[:, t], prefix << rest)
                high[x, :, t] = np.searchsorted(self.keys[:, t], (prefix + np.uint64(1)) << rest)
                if x > 4 and (low[x, :, t] == high[x, :, t]).all():  # no longer prefix is shared by anyone
                    low[x:, :, t] = high[x:, :, t] = 0
                    break
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray, enough: int) -> np.ndarray:
        """low, high[prefix length, tree] of one query: ascends from the longest match until there are ``enough`` rows."""
        n = len(self.vectors)
        together = (high - low).sum(axis=1)
        x = int(np.flatnonzero(together >= min(enough, n))[-1]) if together.max(initial=0) >= min(enough, n) else 0
        while True:
            seen = np.zeros(n, bool)
            for t in range(self.trees):
                if high[x, t] > low[x, t]:
                    seen[self.order[low[x, t] : high[x, t], t]] = True
            found = np.flatnonzero(seen)
            if len(found) >= enough or x == 0:
                return found
            x -= 1


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    at = np.arange(len(ids))
    if len(at) > k:
        at = at[scores >= np.partition(scores, len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def calibrated(forest: Forest, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, recall: float, sample: int) -> int:
    """The number of candidates with which ``sample`` of the queries (by a hash of their ids, so from all over the block) reach ``recall``."""
    some = np.argsort(own.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:sample]
    queries, own = queries[some], own[some]
    ranges, exact = forest.ranges(queries), {}
    for i in range(len(queries)):
        others = np.flatnonzero(ids != own[i])
        exact[i] = set(others[best(forest.vectors[others] @ queries[i], ids[others], k)].tolist())
    total = sum(map(len, exact.values()))
    for share in SHARES:
        enough = int(np.ceil(share * len(ids)))
        found = sum(len(exact[i].intersection(forest.candidates(ranges[0][:, i], ranges[1][:, i], enough).tolist())) for i in exact)
        if found >= recall * total:
            return enough
    return len(ids)


def search_block(queries, rows, k: int, recall: float = 0.97, sample: int = 48, trees: int = 48, bits: int = 48, width: int = 512):
    import pyarrow as pa

    a, b, c = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    if queries.num_rows and rows.num_rows:
        rows = rows.sort_by("vec_id")  # the same forest whatever order the rows came in
        queries = queries.sort_by("vec_id")
        q, r = same_width(matrix(queries["v"]), matrix(rows["v"]))
        own, ids = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        forest = Forest(r, trees, bits)
        enough = calibrated(forest, q, own, ids, k, recall, sample)
        for i in range(0, len(q), width):
            part, mine = q[i : i + width], own[i : i + width]
            ranges = forest.ranges(part)
            for j in range(len(part)):
                at = forest.candidates(ranges[0][:, j], ranges[1][:, j], max(enough, k + 1))
                at = at[ids[at] != mine[j]]
                scores = r[at] @ part[j]
                top = best(scores, ids[at], k)
                a.append(np.full(len(top), mine[j]))
                b.append(ids[at[top]])
                c.append(scores[top])
    return pa.table({"query_id": np.concatenate(a), "vec_id": np.concatenate(b), "score": np.concatenate(c)})


def nearest(rows: DataFrame, queries, *, k: int = 20, recall: float = 0.97, sample: int = 48, trees: int = 48, bits: int = 48, row_block: int = 8192, query_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score (inner product) for the rows of ``rows`` (vec_id, embedding) that fit ``queries``."""
    if not 0 < bits < 64:
        raise ValueError("bits must be between 1 and 63")
    return top_of(usable(rows, zero=False), queries, lambda q, r: search_block(q, r, k, recall, sample, trees, bits), "double", k, row_block, query_block)
