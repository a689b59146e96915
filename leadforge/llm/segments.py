"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments; with their means m and deviations s, the squared distance of x and y is at least the sum of
len * ((mx - my)^2 + (sx - sy)^2). As |x|^2 is the sum of len * (m^2 + s^2), a lower bound of the distance is an upper bound
of the inner product (|x|^2 + |y|^2 - d^2) / 2. Coarse segments go first, finer ones see what is left, and exact products
are computed for the survivors only. A candidate goes only when its bound is below the k-th score already found.

Vectors are scaled and rounded down to whole numbers first. Cases: vectors that are null or hold null or non-finite
components take no part, nor do rows without an id; shorter vectors are filled up with zeros; an id that repeats among the
queries asks once, with its smallest vector, and no row of that id is its candidate; other repeated rows are candidates of
their own. Ties go to the smaller id. Extra columns are not read; empty tables give no rows. Scores beyond 64 bits raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.llm import grid

LEVELS, CHUNK = (4, 16), 64


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that a dot product of two rows bounds that of the vectors."""
    cut = x.reshape(len(x), segments, -1)
    root = np.sqrt(cut.shape[2])
    return np.concatenate([cut.mean(axis=2) * root, cut.std(axis=2) * root], axis=1)


def top(c: np.ndarray, c_ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, levels=LEVELS):
    """For each query (position, candidates' positions, scores) of its ``k`` highest integer inner products."""
    width = max(c.shape[1], q.shape[1], 1)
    step = max(levels)
    width = -(-width // step) * step
    c, q = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (c, q))
    limit = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * width
    if limit >= 2.0**53:  # products that doubles cannot hold: whole numbers of any size
        c, q = (np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (c, q))
        for i in range(len(q)):
            scores = [int(v) if own != q_ids[i] else None for v, own in zip(c @ q[i], c_ids)]
            order = sorted((j for j, s in enumerate(scores) if s is not None), key=lambda j: (-scores[j], c_ids[j]))[:k]
            yield i, np.array(order, np.int64), np.array([scores[j] for j in order], np.int64)
        return
    exact = np.float32 if limit < 2.0**24 else np.float64
    c_stats, q_stats = ([statistics(x, s) for s in levels] for x in (c, q))
    c_whole, q_whole = c.astype(exact), q.astype(exact)
    slack = 1e-9 * (limit + 1)
    for at in range(0, len(q), CHUNK):
        part = slice(at, at + CHUNK)
        own = q_ids[part, None] == c_ids[None, :]
        bound = q_stats[0][part] @ c_stats[0].T
        bound[own] = -np.inf
        # The most promising candidates by the coarse bound give a first k-th score to beat.
        seeds = np.argpartition(bound, -k, axis=1)[:, -k:] if len(c) > k else np.broadcast_to(np.arange(len(c)), bound.shape)
        known = np.einsum("ij,ikj->ik", q_whole[part].astype(np.float64), c_whole[seeds].astype(np.float64)) if len(c) else np.zeros(bound.shape)
        known[np.take_along_axis(bound, seeds, axis=1) == -np.inf] = -np.inf
        least = known.min(axis=1, keepdims=True) if len(c) > k else np.full((len(bound), 1), -np.inf)
        alive = np.flatnonzero((bound >= least - slack).any(axis=0))
        for c_level, q_level in zip(c_stats[1:], q_stats[1:]):
            finer = q_level[part] @ c_level[alive].T
            alive = alive[(finer >= least - slack).any(axis=0)]
        scores = (q_whole[part] @ c_whole[alive].T).astype(np.float64)
        scores[own[:, alive]] = -np.inf
        for row in range(len(scores)):
            places = grid.best(scores[row], c_ids[alive], k)
            yield at + row, alive[places], scores[row][places]


def search(vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", levels=LEVELS) -> DataFrame:
    """The ``k`` highest integer inner products of each query row (``queries`` is a condition) among all other rows."""
    rows = vectors.filter(grid.finite(vector) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), queries.alias("asks"))
    asked = grid.one_per_id(rows.filter("asks"), "vec_id", "vector").withColumnRenamed("vec_id", "query_id")

    def cell(candidates: pa.Table, questions: pa.Table) -> pa.Table:
        c, q = (np.floor(grid.matrix(t.column("vector")) * scale) for t in (candidates, questions))
        c_ids, q_ids = candidates.column("vec_id").to_numpy(), questions.column("query_id").to_numpy()
        out = [(np.full(len(places), q_ids[i]), c_ids[places], scores) for i, places, scores in top(c, c_ids, q, q_ids, k, levels)]
        return grid.found_table([x[0] for x in out], [x[1] for x in out], [np.asarray(x[2]).astype(np.int64) for x in out], pa.int64())

    return grid.search(rows.drop("asks"), asked, cell, k, "long")
