"""Customer cells reduced to feature columns inside tasks: runs of sorted rows, one numpy call per block and metric.

A column is "sum or max of (value when the account is in the block, else 0)". Accounts outside the block therefore
contribute zeros, unless every account of the customer is inside: the zero rules of conditional aggregates.

Amounts stay exact: decimals are whole numbers of their last digit, in 64 bits where every sum of a chunk fits
and as Python's integers otherwise.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells that are reduced together; a customer's cells are bounded by the code lists, so a chunk is little larger.
CHUNK_ROWS = 50_000
# Stands for the cell of a customer without accounts; no block has it.
NO_CELL = -1


def _customer_starts(ids: pa.Array) -> np.ndarray:
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))


def _whole_customers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows in chunks that cut no customer in two."""
    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= CHUNK_ROWS:
            chunk = _joined(held)
            last = int(_customer_starts(chunk.column(0))[-1])
            if last:
                yield chunk.slice(0, last)
            held, rows = [chunk.slice(last)], chunk.num_rows - last
    if rows:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    return pa.RecordBatch.from_arrays([c.chunk(0) for c in table.columns], schema=table.schema)


def _numbers(column: pa.Array, additive: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Values, with one that changes no result where they are missing, and where they are present (None: everywhere)."""
    present = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    if not pa.types.is_decimal(column.type):
        least = -np.inf if pa.types.is_floating(column.type) else np.iinfo(column.type.to_pandas_dtype()).min
        return column.fill_null(0 if additive else least).to_numpy(zero_copy_only=False), present
    limbs = np.frombuffer(column.buffers()[1], np.int64).reshape(-1, 2)[column.offset : column.offset + len(column)]
    low, high = limbs[:, 0], limbs[:, 1]
    if present is not None:
        low, high = np.where(present, low, 0), np.where(present, high, 0)
    bound = 2**62 // max(len(column), 1)
    if np.all((high == low >> 63) & (low >= -bound) & (low <= bound)):
        values, least = low, -(2**63)
    else:
        values = np.array([(h << 64) | (v & 2**64 - 1) for v, h in zip(low.tolist(), high.tolist())], dtype=object)
        least = -(10**39)
    return values if additive or present is None else np.where(present, values, least), present


def _fitting(values: np.ndarray, present: np.ndarray, kind: pa.DataType, ansi: bool) -> np.ndarray:
    """Where values are present and no sum has outgrown its decimal type: an error or NULL, as in Spark's own sum."""
    if values.dtype != object:
        return present
    fits = np.array([abs(v) < 10**kind.precision for v in values], dtype=bool)
    if ansi and not np.all(fits | ~present):
        raise ArithmeticError(f"a sum of amounts does not fit {kind}")
    return present & fits


def _column(values: np.ndarray, present: np.ndarray, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_decimal(kind):
        return pa.array(values, pa.int64() if pa.types.is_integer(kind) else kind, mask=~present)
    if values.dtype == object:
        limbs = np.array([(v & 2**64 - 1, v >> 64 & 2**64 - 1) for v in np.where(present, values, 0)], dtype=np.uint64)
    else:
        limbs = np.stack([values, values >> 63], axis=1)
    buffers = [pa.array(present).buffers()[1], pa.py_buffer(np.ascontiguousarray(limbs))]
    return pa.Array.from_buffers(kind, len(values), buffers)


class _Chunk:
    """The cells of whole customers, and their blocks as far as they are asked for."""

    def __init__(self, cells: pa.RecordBatch, members: dict[str, set[int]], additive: set[str], ansi: bool):
        self.cells, self.members, self.additive, self.ansi = cells, members, additive, ansi
        self.starts = _customer_starts(cells.column(0))
        self.customer = np.repeat(np.arange(len(self.starts)), np.diff(self.starts, append=cells.num_rows))
        self.kinds, self.kind = np.unique(cells.column(1).fill_null(NO_CELL).to_numpy(), return_inverse=True)
        self.numbers, self.places, self.slots = {}, {}, {}

    def place(self, block: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's rows, where in them each customer begins, and these customers."""
        if block not in self.places:
            rows = np.flatnonzero(np.isin(self.kinds, list(self.members[block]))[self.kind])
            owner = self.customer[rows]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(rows) else rows
            self.places[block] = rows, first, owner[first]
        return self.places[block]

    def slot(self, block: str, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """A metric over the block's cells of each customer, and where there is one; 0 elsewhere."""
        if (block, metric) not in self.slots:
            if metric not in self.numbers:
                self.numbers[metric] = _numbers(self.cells.column(metric), metric in self.additive)
            (values, given), (rows, first, owners) = self.numbers[metric], self.place(block)
            found, present = np.zeros(len(self.starts), values.dtype), np.zeros(len(self.starts), bool)
            if len(rows):
                found[owners] = (np.add if metric in self.additive else np.maximum).reduceat(values[rows], first)
                present[owners] = True if given is None else np.logical_or.reduceat(given[rows], first)
            present = _fitting(found, present, self.type(metric), self.ansi)
            self.slots[block, metric] = np.where(present, found, 0), present
        return self.slots[block, metric]

    def type(self, metric: str) -> pa.DataType:
        return self.cells.schema.field(metric).type

    def feature(self, block: str, metric: str, settled_by: str) -> pa.Array:
        """The feature's column: without a value it is NULL only where no account of the customer is outside the block."""
        everywhere = np.ones(len(self.starts), bool)
        if metric == "ever":
            return _column(np.minimum(self.slot(block, "count")[0], 1), everywhere, self.type("count"))
        values, present = self.slot(block, metric)
        if metric.startswith(("count", "opened")) or metric.endswith(("limit", "limit_active")):
            return _column(values, everywhere, self.type(metric))
        outsiders = self.slot(block, settled_by)[0] < self.slot("everything", "count")[0]
        if metric not in self.additive:
            values = np.where(outsiders, np.maximum(values, 0), values)
        return _column(values, present | outsiders, self.type(metric))


def feature_reducer(
    features: list[tuple[str, str, str, str]], members: dict[str, set[int]], additive: set[str], ansi: bool, key: str = "customer_id"
):
    """A function over batches of (customer_id, cell, metrics...), sorted by customer: one row of ``slots`` per customer.

    ``features`` lists (name, block, metric, count that settles NULL and zero); ``members`` has the cells of each block.
    ``key`` is the column that comes out beside ``slots``, taken from the first row of a customer. A customer whose only
    row has no cell has no accounts, and NULL for ``slots``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _whole_customers(batches):
            chunk = _Chunk(cells, members, additive, ansi)
            columns = [chunk.feature(*feature) for _, *feature in features]
            first = pa.array(chunk.starts)
            without = cells.column(1).take(first).is_null()
            slots = pa.StructArray.from_arrays(columns, names=[name for name, *_ in features], mask=without)
            yield pa.RecordBatch.from_arrays([cells.column(key).take(first), slots], names=[key, "slots"])

    return run
