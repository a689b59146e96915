"""A stated query set against all vectors, in blocks: every block of candidates meets every block of queries once.

Both sides are dealt into blocks of bounded size by a hash of their ids, so a cell of the grid holds at most about
``CANDIDATES`` by ``QUERIES`` vectors whatever the size of the table. A cell gives each query its best candidates; those
few are merged per query.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadforge.llm.common import ship

CANDIDATES, QUERIES = 4096, 2048


def finite(vector: str | Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def one_per_id(queries: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """An id that repeats among the queries asks once, with its smallest vector."""
    return queries.groupBy(vec_id).agg(F.min(vector).alias(vector))


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0, dtype=np.float64) -> np.ndarray:
    """A list column as a matrix; shorter vectors are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(column) == 0:
        return np.zeros((0, width), dtype)
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(dtype)
    width = max(width, int(lengths.max()))
    if (lengths == width).all():
        return flat.reshape(-1, width)
    full = np.zeros((len(lengths), width), dtype)
    full[np.arange(width)[None, :] < lengths[:, None]] = flat
    return full


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to smaller ids; minus infinity takes no part."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero((scores >= least) & (scores > -np.inf))
    else:
        places = np.flatnonzero(scores > -np.inf)
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def search(candidates: DataFrame, queries: DataFrame, cell: Callable, k: int, score_type: str, candidate_id: str = "vec_id", query_id: str = "query_id") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` best of what ``cell(candidates, queries)`` finds in every cell."""
    ship(candidates.sparkSession)
    n_c = max(1, math.ceil(candidates.count() / CANDIDATES))
    n_q = max(1, math.ceil(queries.count() / QUERIES))
    left = candidates.withColumn("block", F.pmod(F.xxhash64(candidate_id), F.lit(n_c))).withColumn("cell", F.explode(F.sequence(F.col("block") * n_q, F.col("block") * n_q + n_q - 1)))
    right = queries.withColumn("block", F.pmod(F.xxhash64(query_id, F.lit(7)), F.lit(n_q))).withColumn("cell", F.explode(F.sequence(F.col("block"), F.col("block") + F.lit((n_c - 1) * n_q), F.lit(n_q))))
    n = n_c * n_q
    left, right = (x.drop("block").repartition(n, "cell").groupBy("cell") for x in (left, right))
    found = left.cogroup(right).applyInArrow(cell, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def found_table(query_ids: list, vec_ids: list, scores: list, score_type: pa.DataType) -> pa.Table:
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.table({
        "query_id": pa.array(join(query_ids, np.int64), pa.int64()), "vec_id": pa.array(join(vec_ids, np.int64), pa.int64()),
        "score": pa.array(join(scores, np.float64), score_type),
    })
