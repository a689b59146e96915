"""Near-duplicates by SimHash, found with fuzzy hash keys from the binary Golay code.

The 64 bits of a fingerprint are cut into three segments of 22, 21 and 21 bits. Three wrong bits leave at least two segments
with one wrong bit at most. The perfect (23, 12) Golay code decodes every word to the one codeword within 3 bits; the words
within one bit of a segment decode to a handful of codeword indices. For each pair of segments a fingerprint gives the keys
(indices near its first, index of its second) on one side and (index of its first, indices near its second) on the other:
two fingerprints within 3 bits meet in a key of some pair, whichever is on which side. Meetings are verified on all 64 bits.

Equal fingerprints are one node. A bucket that many fingerprints share emits a spanning forest of its links instead of all
pairs, and a bucket too large for one task is cut into a grid of parts that all meet. Components are joined by alternating
star contraction.

Cases: a null text has no words, like an empty one; without words the fingerprint is zero, and links like any other; with
fewer words than a shingle has, the whole sequence is the shingle. A null id never names a component unless no other id is
there. Rows that repeat an id are documents of their own. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm.common import guarded_broadcast, ship, stored, tidy

WORDS, DISTANCE, SEED = 3, 3, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = tuple(combinations(range(3), 2))
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the polynomial of the Golay code
SMALL, HOT = 64, 8192
BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash over the XXH64 of all word shingles; a bit is set if it is in over half of the hashes."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space cuts
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros((8, 8), np.int64), len(parts) - words + 1
    for at in range(0, n, 1 << 16):
        a, b = starts[at : min(at + (1 << 16), n)].tolist(), ends[at + words - 1 : min(at + (1 << 16), n) + words - 1].tolist()
        lanes = np.array([digest(joined[x:y], seed) for x, y in zip(a, b)], np.uint64).view(np.uint8).reshape(-1, 8)
        for lane in range(8):
            counts[lane] += np.bincount(lanes[:, lane], minlength=256) @ BYTE_BITS
    bits = (counts.ravel() * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, bits): the fingerprint of every whole text as a signed long; columns named in ``keep`` are carried along."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), words, seed) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), *batch.columns[2:]], names=["doc_id", "bits", *keep])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("bits", T.LongType()), *[docs.schema[c] for c in keep]])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text, *keep).mapInArrow(tidy(run), schema)


class Golay:
    """Decoding by syndrome: 2^11 syndromes stand for the error patterns of up to 3 of 23 bits."""

    def __init__(self):
        remainders = np.zeros(4096, np.int64)
        for message in range(4096):
            value = message << 11
            for bit in range(22, 10, -1):
                if value >> bit & 1:
                    value ^= GENERATOR << (bit - 11)
            remainders[message] = value
        self.remainders = remainders
        self.errors = np.zeros(2048, np.int64)
        for weight in range(1, 4):
            for places in combinations(range(23), weight):
                pattern = sum(1 << p for p in places)
                self.errors[remainders[pattern >> 11] ^ (pattern & 0x7FF)] = pattern

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12-bit index of the codeword nearest to each 23-bit word."""
        return (words ^ self.errors[self.remainders[words >> 11] ^ (words & 0x7FF)]) >> 11

    def near(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of all words within one bit of each word: (row, index) without repeats."""
        flips = np.concatenate([[0], 1 << np.arange(width)])
        all_of = np.sort(self.index(words[:, None] ^ flips[None, :]), axis=1)
        fresh = np.ones(all_of.shape, bool)
        fresh[:, 1:] = all_of[:, 1:] != all_of[:, :-1]
        return np.nonzero(fresh)[0], all_of[fresh]


def keys(bits: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, side, row) of all keys of the fingerprints."""
    cut = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    own = [code.index(x) for x in cut]
    near = [code.near(x, width) for x, (_, width) in zip(cut, SEGMENTS)]
    key, side, row = [], [], []
    for pair, (i, j) in enumerate(PAIRS):
        rows, index = near[i]
        key.append(pair << 24 | index << 12 | own[j][rows])
        row.append(rows)
        side.append(np.zeros(len(rows), np.int8))
        rows, index = near[j]
        key.append(pair << 24 | own[i][rows] << 12 | index)
        row.append(rows)
        side.append(np.ones(len(rows), np.int8))
    return np.concatenate(key), np.concatenate(side), np.concatenate(row)


def forest(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links from each component's first fingerprint to its others, searched breadth first."""
    left, heads, others = np.unique(bits), [], []
    while len(left) > 1:
        head, frontier, left = left[0], left[:1], left[1:]
        while len(frontier) and len(left):
            found = np.zeros(len(left), bool)
            for at in range(0, len(frontier), 256):
                found |= (np.bitwise_count(frontier[at : at + 256, None] ^ left[None, :]) <= distance).any(axis=0)
            frontier, left = left[found], left[~found]
            heads.append(np.full(len(frontier), head))
            others.append(frontier)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *heads]), np.concatenate([empty, *others])


def links_of(key: np.ndarray, side: np.ndarray, bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key: all verified pairs of small buckets, forests of the others."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(starts, len(key)))
    right = np.add.reduceat(side.astype(np.int64), starts)
    both = (right > 0) & (right < n)
    small = both & ((n - right) * right <= SMALL)
    u, v = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for at in np.flatnonzero(both & ~small):
        a, b = forest(bits[starts[at] : starts[at] + n[at]], distance)
        u.append(a)
        v.append(b)
    # Rows are sorted by side inside a key; every left row meets every right row.
    s, r, w = starts[small], right[small], (n - right)[small]
    run = np.repeat(np.arange(len(s)), r * w)
    place = np.arange(len(run)) - np.repeat(np.cumsum(r * w) - r * w, r * w)
    x, y = bits[s[run] + place // r[run]], bits[s[run] + w[run] + place % r[run]]
    linked = (x != y) & (np.bitwise_count(x ^ y) <= distance)
    return np.concatenate([*u, x[linked]]), np.concatenate([*v, y[linked]])


def links(nodes: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Links (a, b), a > b, that join all distinct fingerprints (column ``bits``) within ``distance`` bits of each other."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys find links of up to 3 bits")
    ship(nodes.sparkSession)

    def spread(batches):
        code = Golay()
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(bits), 4096):
                part = bits[at : at + 4096]
                key, side, row = keys(part, code)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side), pa.array(part[row].view(np.int64))], names=["key", "side", "bits"])

    def meet(batches):
        held = None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            last = np.searchsorted(rows[0], rows[0][-1])  # the last bucket may go on in the next batch
            held = [x[last:] for x in rows]
            if last:
                yield linked(*[x[:last] for x in rows])
        if held is not None and len(held[0]):
            yield linked(*held)

    def linked(key, side, bits):
        u, v = (x.view(np.int64) for x in links_of(key, side, bits.view(np.uint64), distance))
        pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    rows = stored(nodes.select("bits").mapInArrow(tidy(spread), "key long, side byte, bits long"), "keys")
    large = stored(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot), "hot")
    large = large.select("key", F.ceil(F.col("n") / hot).cast("long").alias("parts"))
    # A hot bucket becomes a grid: a left row goes to one line of it, a right row to one column.
    cut = rows.join(guarded_broadcast(large, large.count()), "key", "left")
    part = F.pmod(F.xxhash64("bits"), F.coalesce("parts", F.lit(1)))
    steps = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)
    cells = F.transform(steps, lambda s: F.when(F.col("side") == 0, part * F.coalesce("parts", F.lit(1)) + s).otherwise(s * F.coalesce("parts", F.lit(1)) + part))
    spreaded = cut.select(F.explode(cells).alias("cell"), "key", "side", "bits").select((F.col("cell") * F.lit(1 << 26) + F.col("key")).alias("key"), "side", "bits")
    met = spreaded.repartition("key").sortWithinPartitions("key", "side").mapInArrow(tidy(meet), "a long, b long")
    return met.distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (a, b): every node that has a smaller one in its component, with the smallest. Edges have a > b."""
    edges = stored(edges, "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lowest, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stored(small.unionByName(lowest.select("a", F.col("least").alias("b"))).distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40)), F.sum(F.xxhash64("b", "a") % F.lit(1 << 40))).first()
        if state == seen:
            return edges
        seen = state


def members(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, bits, the columns in ``keep``, its component's smallest fingerprint (root) and smallest id."""
    prints = stored(fingerprints(docs, doc_id, text, words, seed, keep), "prints")
    nodes = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes, distance))
    homes = nodes.join(roots.withColumnRenamed("a", "bits"), "bits", "left").select("bits", F.coalesce("b", "bits").alias("root"), "first")
    named = homes.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(homes.join(named, "root").select("bits", "root", "component_id"), "bits")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, its fingerprint in hex, and the smallest id of its component."""
    return members(docs, doc_id, text, words, distance, seed).select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
