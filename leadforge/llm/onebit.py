"""Approximate nearest neighbours by inner product over randomly rotated one-bit codes.

The index holds of every vector, taken from a centre and rotated at random, one sign per coordinate, its length, and the
cosine a between the vector and its signs. <signs, q> / a estimates the inner product with a rotated query without bias,
and its error is below |q| * sqrt((1 - a^2) / a^2) * ``spread`` / sqrt(bits - 1) with a probability that ``spread`` sets.
Candidates whose estimate plus error reaches the k-th exact product found so far are reranked with the original vectors.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id; shorter
vectors are filled up with zeros; an id that repeats among the queries asks once, with its smallest vector, and no row of
that id is its candidate. Ties go to the smaller id. Extra columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm import grid
from leadforge.llm.common import ship, stored

SPREAD, SEED, CHUNK, SAMPLE = 2.5, 42, 64, 4096


def rotation(bits: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return q * np.sign(np.diag(r))


def code_bits(width: int) -> int:
    """Twice the width in whole 64-bit words: more signs than coordinates narrow the error."""
    return max(64, -(-2 * width // 64) * 64)


def encode(x: np.ndarray, centre: np.ndarray, bits: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length and cosine of each row."""
    moved = np.zeros((len(x), bits))
    moved[:, : x.shape[1]] = x
    moved[:, : len(centre)] -= centre
    turned = moved @ rotation(bits, seed).T
    length = np.sqrt((turned**2).sum(axis=1))
    cosine = np.abs(turned).sum(axis=1) / np.sqrt(bits) / np.where(length > 0, length, 1)
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, cosine, 1.0)


def centre_of(vectors: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The mean of at most ``sample`` vectors, those of the smallest hash of their id. Any centre gives right bounds."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    x = grid.matrix(rows.column("vector"))
    return x.mean(axis=0) if len(x) else np.zeros(0)


def index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", seed: int = SEED) -> tuple[DataFrame, np.ndarray, int]:
    """The index of every row (vec_id, vector, code, length, cosine), written to the shared folder; its centre and bits."""
    ship(vectors.sparkSession)
    usable = grid.finite(vector) & F.col(vec_id).isNotNull() & F.exists(vector, lambda x: x != 0)
    rows = vectors.filter(usable).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    centre = centre_of(rows)
    width = max(len(centre), rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    bits = code_bits(width)

    def run(batches):
        for batch in batches:
            code, length, cosine = encode(grid.matrix(batch.column("vector")), centre, bits, seed)
            added = [pa.array([row.tobytes() for row in code], pa.binary()), pa.array(length), pa.array(cosine)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "code", "length", "cosine"])

    fields = [*rows.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("length", T.DoubleType()), T.StructField("cosine", T.DoubleType())]
    return stored(rows.mapInArrow(run, T.StructType(fields)), "codes"), centre, bits


def _products(q: np.ndarray, c: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Inner products of pairs of columns, added from the first component on, so that equal vectors score the same."""
    total = np.zeros(len(qi))
    for q_row, c_row in zip(q, c):
        total += q_row[qi] * c_row[ci]
    return total


def top(c, c_ids, code, length, cosine, q, q_ids, centre, bits, k, spread=SPREAD, seed=SEED):
    """For each query (position, candidates' positions, exact scores) of its ``k`` best among the reranked."""
    signs = (np.unpackbits(code, axis=1, count=bits).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(bits))
    wide = np.zeros((len(q), bits))
    wide[:, : q.shape[1]] = q
    turned = (wide @ rotation(bits, seed).T).astype(np.float32)
    q_length = np.sqrt((q**2).sum(axis=1))
    wide_centre = np.zeros(q.shape[1])
    wide_centre[: len(centre)] = centre
    base = q @ wide_centre
    q_across, c_across = np.ascontiguousarray(q.T), np.ascontiguousarray(c.T)
    factor = (length / cosine).astype(np.float32)
    error = (length * np.sqrt(np.maximum(0, 1 - cosine**2)) / cosine * spread / np.sqrt(bits - 1)).astype(np.float32)
    for at in range(0, len(q), CHUNK):
        part = slice(at, at + CHUNK)
        own = q_ids[part, None] == c_ids[None, :]
        estimate = (turned[part] @ signs.T) * factor + base[part, None].astype(np.float32)
        estimate[own] = -np.inf
        rows = len(estimate)
        if len(c) > k:
            seeds = np.argpartition(estimate, -k, axis=1)[:, -k:]
            known = _products(q_across, c_across, np.repeat(np.arange(at, at + rows), k), seeds.ravel()).reshape(rows, k)
            known[np.take_along_axis(estimate, seeds, axis=1) == -np.inf] = -np.inf
            least = known.min(axis=1, keepdims=True)
        else:
            least = np.full((rows, 1), -np.inf)
        slack = 1e-5 * (1 + np.abs(least)) if np.isfinite(least).all() else 0.0
        qi, ci = np.nonzero((estimate + error * q_length[part, None].astype(np.float32) >= least - slack) & ~own)
        scores = _products(q_across, c_across, qi + at, ci)
        edges = np.searchsorted(qi, np.arange(rows + 1))
        for row in range(rows):
            a, b = edges[row], edges[row + 1]
            places = grid.best(scores[a:b], c_ids[ci[a:b]], k)
            yield at + row, ci[a:b][places], scores[a:b][places]


def search(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", spread: float = SPREAD, seed: int = SEED) -> DataFrame:
    """The ``k`` nearest rows found for each query row (``queries`` is a condition), with their exact inner products."""
    rows, centre, bits = index(vectors, vec_id, vector, seed)
    asking = vectors.filter(queries).select(F.col(vec_id).cast("long").alias("vec_id")).distinct()
    asked = grid.one_per_id(rows.select("vec_id", "vector").join(asking, "vec_id", "left_semi"), "vec_id", "vector").withColumnRenamed("vec_id", "query_id")

    def cell(candidates: pa.Table, questions: pa.Table) -> pa.Table:
        c, q = grid.matrix(candidates.column("vector")), grid.matrix(questions.column("vector"))
        width = max(c.shape[1], q.shape[1], len(centre))
        c, q = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (c, q))
        c_ids, q_ids = candidates.column("vec_id").to_numpy(), questions.column("query_id").to_numpy()
        code = np.frombuffer(b"".join(candidates.column("code").to_pylist()), np.uint8).reshape(len(c), bits // 8)
        length, cosine = candidates.column("length").to_numpy(), candidates.column("cosine").to_numpy()
        out = [(np.full(len(places), q_ids[i]), c_ids[places], scores) for i, places, scores in top(c, c_ids, code, length, cosine, q, q_ids, centre, bits, k, spread, seed)]
        return grid.found_table([x[0] for x in out], [x[1] for x in out], [x[2] for x in out], pa.float64())

    return grid.search(rows, asked, cell, k, "double")
