"""Exact Jaccard join of word shingle sets as a join in a metric space.

One minus the Jaccard similarity is a metric, so a pivot cuts the space into regions, and two sets within ``e`` of each other
(0.2 for a similarity of 0.8) can only be in different regions if one of them lies within a window at the border.

First come single shingles as pivots, in one order for all sets (rare ones first). The region of a pivot holds the sets whose first
shingle it is. A set of n shingles is at distance (j - 1) / n of the region of its j-th shingle, so it is copied to the regions of the
first n - ceil(0.8 n) + 1 of them: of the shingles before the first common one the other set has none, and at most 0.2 n
may be missing. Two close sets so meet in the region of their first common shingle; most regions hold one set and are gone.

In every region the first member is a pivot, and the links to it are decided. Regions whose members are not all connected yet go on.
Large ones get documents as pivots: a member within e of a pivot is in the core of the nearest such one; who is within 2 e of a
pivot and not connected with it is copied into its region as well, as by the triangle inequality no other can be within e of the core;
who is in no core forms a region of the rest; and all are joined again in the same way without the pivots, whose links are decided.
Small ones, of a fixed number of members at most, compare what is not connected yet, as do, block by block, larger ones that pivots
do not make smaller. Before texts are compared, two bounds drop a pair: the sizes (distances from the empty set), and the
classes of hashes of which a set has an odd number of shingles, as at least one shingle per class that differs is in one set only.

A set is a node once, however many documents have it. Shingles are compared by 64-bit hashes. Only components are asked for, so links
within a component that is connected already are not looked for. The frequent shingles (at most ``FREQUENT``, counted by
what is frequent within a part of the rows) decide the order of pivots and nothing else.

Cases: a null text is empty; a document without words has no shingles and is linked with nothing, not even another one; one with fewer
words than a shingle has is one shingle; a null id names a component only if no other id is there; rows that repeat an id are documents
of their own; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadforge.llm.common import ship, stored, tidy
from leadforge.llm.simhash import components

WORDS, PERCENT = 5, 80
FINE = 2  # classes of the finer parities per shingle
LEAF, PIVOTS = 2048, 16  # members of the largest region that is not cut again; pivots of a larger one, or one for each 64 members
BEST, GATHERED = 4, 1 << 19  # partners of a member in the first comparison of a region; pairs that a task frees of repeats at once
FREQUENT, SEEN, HELD = 65_536, 8, 1 << 22  # frequent shingles; how often within HELD shingles one must be seen
BITS = 1 << 26  # of the bitmap that tells which texts may be wanted
BLOCK = 200_000  # shingles compared with one copy of a pivot
PIECE = 1 << 20  # bytes of text hashed at once
TURN, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def _letters() -> np.ndarray:
    values = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(256)], np.uint64)
    values[0x41:0x5B] = values[0x61:0x7B]
    values[WHITE] = 0
    return values


WHITE = [0x20, *range(0x09, 0x0E)]
LETTERS = _letters()
LONG = 256  # bytes; longer words are hashed whole
POWERS = np.cumprod(np.full(LONG, TURN))


def word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word in the bytes; no word goes over one of the places in ``begins``."""
    values = LETTERS[data]
    inside = values != 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = begins[begins < len(data)]
    start[begins] = inside[begins]
    places = np.flatnonzero(start)
    if not len(places):
        return np.zeros(0, np.uint64), places
    values = values[places[0] :]
    lengths = np.diff(np.append(places, len(data)))
    values *= POWERS[np.minimum(np.arange(len(values)) - np.repeat(places - places[0], lengths), LONG - 1)]
    hashes = np.add.reduceat(values, places - places[0])
    for i in np.flatnonzero(lengths > LONG):  # its white space behind it counts along
        word = data[places[i] : places[i] + lengths[i]].tobytes().strip(b" \t\n\x0b\f\r")
        if len(word) > LONG:
            hashes[i] = xxhash.xxh64_intdigest(word.lower())
    return hashes, places


def _mixed(own: np.ndarray, width: int) -> np.ndarray:
    n = len(own) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ own[i : i + n]) * TURN
        mixed ^= mixed >> SHIFT
    return mixed


def _of_words(hashes: np.ndarray, words: int) -> np.ndarray:
    return np.unique(_mixed(hashes, min(words, len(hashes)))) if len(hashes) else hashes


def _long_text(data: np.ndarray, words: int) -> np.ndarray:
    """A text of many megabytes: its words piece by piece, cut behind white space."""
    parts, at, nothing = [], 0, np.zeros(0, np.int64)
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data):
            white = np.flatnonzero(LETTERS[data[at:end]] == 0)
            if len(white):
                end = at + int(white[-1]) + 1
                break
            end = min(end + PIECE, len(data))  # one word; it is hashed whole
        parts.append(word_hashes(data[at:end], nothing)[0])
        at = end
    return _of_words(np.concatenate(parts), words)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its different shingles; short texts are hashed many at once."""
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        last = min(last, len(column))
        some = data[offsets[first] : offsets[last]]
        if len(some) > PIECE:
            yield _long_text(some, words)
        else:
            begins = offsets[first:last] - offsets[first]
            hashes, places = word_hashes(some, begins)
            edges = np.append(np.searchsorted(places, begins), len(places))
            mixed = _mixed(hashes, words) if len(hashes) >= words else None
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                yield np.unique(mixed[a : b - words + 1]) if b - a >= words else _of_words(hashes[a:b], words)
        first = last


def overlap(n: int, percent: int) -> int:
    """The least number of a set's n shingles that a close set has."""
    return -(-percent * n // 100)


def parities(own: np.ndarray, per: int) -> np.ndarray:
    """For classes of hashes, ``per`` to 2 ``per`` times as many as shingles, whether a set has an odd number of their shingles; packed bits."""
    classes = max(512, 1 << (per * len(own) - 1).bit_length()) if len(own) else 512
    odd = np.bincount((own & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(bits: np.ndarray, n: int) -> np.ndarray:
    """The parities (last axis) for fewer classes: those are the low bits of a hash, so the finer ones add up to the coarser ones."""
    while bits.shape[-1] > n:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def apart(x: bytes, y: bytes) -> int:
    """In how many classes parities differ: at least so many shingles are in one set only."""
    a, b = (np.frombuffer(v, np.uint64) for v in (x, y))
    n = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, n) ^ folded(b, n)).sum())


def ordered(own: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The shingles in the order of pivots: by weight, which is 0 for all that are not frequent, then by hash."""
    if not len(hashes) or not len(own):
        return own
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    return own[np.lexsort((own, np.where(hashes[at] == own, weights[at], 0)))]


def prints(docs: DataFrame, words: int) -> DataFrame:
    """Over (doc_id, text): each row's number of shingles and its set's digest (kind 0), and shingles seen often in a part (kind 1)."""

    def often(held):
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        some = counts >= SEEN
        n = int(some.sum())
        return _typed(PRINT, [np.ones(n, np.int8), values[some].view(np.int64), counts[some], [None] * n])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            out = []
            for own in shingle_sets(batch.column(1), words):
                out.append((len(own), xxhash.xxh3_128_digest(own.tobytes())))
                held.append(own)
                size += len(own)
                if size > HELD:
                    yield often(held)
                    held, size = [], 0
            n, digest = list(zip(*out)) or ((), ())
            yield _typed(PRINT, [np.zeros(len(n), np.int8), batch.column(0), n, digest])
        if held:
            yield often(held)

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "kind byte, doc_id long, n long, digest binary")


PRINT = pa.schema([("kind", pa.int8()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])


def _typed(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def frequent(printed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and weights of the most frequent shingles: a list of bounded length."""
    counts = printed.filter("kind = 1").groupBy(F.col("doc_id").alias("hash")).agg(F.sum("n").alias("n"))
    top = sorted((int(r.hash) & 0xFFFFFFFFFFFFFFFF, int(r.n).bit_length()) for r in counts.orderBy(F.desc("n"), "hash").limit(FREQUENT).collect())
    return np.array([h for h, _ in top], np.uint64), np.array([w for _, w in top], np.int64)


def sets(docs: DataFrame, often: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """Over (doc_id, text, content): each row's number of shingles, its set's digest, its parities (finer and coarser ones), and its pivots in order."""
    sent = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        for batch in batches:
            out = []
            for own in shingle_sets(batch.column(1), words):
                pivots = ordered(own, *sent.value)[: len(own) - overlap(len(own), percent) + 1]
                out.append((len(own), xxhash.xxh3_128_digest(own.tobytes()), parities(own, FINE).tobytes(), parities(own, 1).tobytes(), pivots.tobytes()))
            made = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, (pa.int32(), *[pa.binary()] * 4))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made], names=["doc_id", "content", "n", "digest", "fine", "coarse", "keys"])

    return docs.select("doc_id", "text", "content").mapInArrow(tidy(run), "doc_id long, content binary, n int, digest binary, fine binary, coarse binary, keys binary")


def _stars(batches, percent: int):
    """Over (key, node, n) sorted by key and node: pairs (kind 0) of each region's first member with the others, if their sizes allow a
    link, and the other rows (kind 1) of regions of three or more."""
    open_rows, told = None, False  # the first rows (three at most) of the region that may go on, and whether they are out as rows
    for batch in batches:
        keys, nodes, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(keys):
            continue
        before = 0 if open_rows is None else len(open_rows[0])
        if before:
            keys, nodes, sizes = (np.concatenate(x) for x in zip(open_rows, (keys, nodes, sizes)))
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        members = np.diff(np.append(starts, len(keys)))
        first = np.repeat(starts, members)
        new = np.arange(len(keys)) >= before
        star = new & (np.arange(len(keys)) > first) & (100 * np.minimum(sizes, sizes[first]) >= percent * np.maximum(sizes, sizes[first]))
        row = np.repeat(members >= 3, members) & (new | (not told)) & (np.arange(len(keys)) > first)
        yield _kinds(np.zeros(star.sum(), np.int8), keys[star], nodes[star], nodes[first[star]])
        yield _kinds(np.ones(row.sum(), np.int8), keys[row], nodes[row], sizes[row].astype(np.int64))
        last, told = starts[-1], bool(members[-1] >= 3)
        open_rows = [x[last : last + 3] for x in (keys, nodes, sizes)]


def _kinds(kind, key, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, key, a, b)], names=["kind", "key", "a", "b"])


def regions(classes: DataFrame, percent: int) -> DataFrame:
    """Rows (key, node, n): the sets in the regions of their first shingles."""

    def run(batches):
        for batch in batches:
            for node, n, keys in zip(*batch.columns):
                own = np.frombuffer(keys.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), node.as_py())), pa.array(np.full(len(own), n.as_py(), np.int32))], names=["key", "node", "n"])

    return classes.select("node", "n", "keys").mapInArrow(tidy(lambda b: _large(run(b))), "key long, node long, n int")


def _large(batches, rows: int = 50_000):
    """The batches put together to larger ones."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bounds by size and by parities do not drop, with both sizes."""
    side = lambda name: classes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("fine").alias(f"fine_{name}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column(2).to_numpy().astype(np.int64) + batch.column(4).to_numpy()
            differ = np.array([apart(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())], np.int64)
            # i common ones of n make a similarity of i / (n - i), and n - 2 i that are not common.
            yield batch.filter(pa.array(differ * (100 + percent) <= n * (100 - percent))).select([0, 1, 2, 4])

    pairs = stored(pairs, "candidates")  # of known size: Spark sees which side is the small one
    fitting = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return fitting.select("a", "b", "n_a", "fine_a", "n_b", "fine_b").mapInArrow(tidy(run), "a long, b long, n_a int, n_b int")


def _maybe(docs: DataFrame, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The documents whose content may be wanted, by a bitmap of bounded size; few others travel to the join that decides."""
    at = F.pmod(F.xxhash64("content"), F.lit(bits))
    bitmap = wanted.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1
    found = docs.join(F.broadcast(bitmap), F.bitmap_bucket_number(at) == F.col("bucket"))  # bits / 32,768 rows of 4 KB
    return found.filter(marked).select("text", "content")


def compared(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Of plausible pairs (a, b) those with a similarity of at least ``percent``: their common shingles and all shingles of both.

    Only the texts of these pairs are fetched. Each a meets its partners in blocks of bounded size, one after another as a stream.
    """

    def run(batches):
        pivot = None
        for batch in batches:
            out = []
            for a, b, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), shingle_sets(batch.column(3), words)):
                if b is None:
                    pivot = own
                    continue
                n = len(pivot) + len(own)
                common = n - len(np.union1d(pivot, own))
                if 100 * common >= percent * (n - common):
                    out.append((a, b, common, n - common))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["a", "b", "common", "whole"])

    pairs = stored(pairs, "pairs")
    members = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(classes.select("node", "content").join(members, "node", "left_semi"), "wanted")
    texts = stored(_maybe(docs.select("text", "content"), wanted).join(wanted, "content").groupBy("content", "node").agg(F.first("text").alias("text")).select("node", "text"), "texts")
    blocks = pairs.groupBy("a").agg(F.ceil(F.sum("n_b") / BLOCK).cast("int").alias("blocks"))
    right = pairs.join(blocks, "a").join(texts.withColumnRenamed("node", "b"), "b")
    right = right.select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b", "text")
    left = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(texts.withColumnRenamed("node", "a"), "a")
    rows = left.select("a", "block", F.lit(None).cast("long").alias("b"), "text").unionByName(right)
    return rows.repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first()).mapInArrow(
        tidy(run), "a long, b long, common int, whole int")


def _links(pairs: DataFrame, percent: int) -> DataFrame:
    linked = pairs.filter(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("whole"))
    return linked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _rooted(rows: DataFrame, roots: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    """The rows with the root of each node: the least node known to be connected with it."""
    named = rows.join(roots.select(F.col("a").alias(node), F.col("b").alias("__root")), node, "left")
    return named.withColumn(root, F.coalesce("__root", node)).drop("__root")


def _alive(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (key, node, n, root, members, main) of regions whose members are not all connected; of equal regions one stays."""
    named = stored(_rooted(rows, roots), "members")
    total = [F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(2)]
    sizes = named.groupBy("key", "root").agg(F.count("*").alias("n"), *total)
    whole = sizes.groupBy("key").agg(F.sum("n").alias("members"), F.count("*").alias("parts"), F.max_by("root", "n").alias("main"), F.sum("s0").alias("s0"), F.sum("s1").alias("s1"))
    single = whole.filter("parts > 1").groupBy("members", "s0", "s1").agg(F.min(F.struct("key", "main")).alias("one"))
    return named.join(single.select("one.key", "one.main", "members"), "key")


def _cells(rows: DataFrame, leaf: int) -> DataFrame:
    """Rows (cell, mark, node): a region of more than ``leaf`` members as a grid of cells of blocks, in which only different blocks meet."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("members") * 2 / F.lit(leaf))).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    cell = lambda other: F.struct(F.least(F.col("own"), other).alias("low"), F.greatest(F.col("own"), other).alias("high"))
    spread = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("at", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), cell)))
    return spread.select("node", "n", "root", F.xxhash64("key", "at.low", "at.high").alias("cell"), F.when(F.col("at.low") == F.col("at.high"), -1).otherwise(F.col("own")).alias("mark"))


def _leaves(rows: DataFrame, classes: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Pairs (a, b) of regions that are not connected yet and that neither their sizes nor their coarser parities rule out.

    With ``best`` only so many of each member, the likeliest ones: links among those leave little to compare for all others. The cells in
    which a member has more come as rows (cell, null).
    """

    def region(more, nodes, sizes, roots, marks, bits):
        # Sorted by size, so partners have as many classes or more, and their sizes go up to the largest that a link allows.
        last = np.searchsorted(100 * sizes, 10_000 * sizes // percent, "right")
        wide = [len(x) for x in bits]
        by_width = {}
        for width in sorted(set(wide)):
            first = wide.index(width)
            by_width[width] = (first, np.stack([folded(np.frombuffer(x, np.uint64), width // 8) for x in bits[first:]]))
        for i in range(len(nodes) - 1):
            some = slice(i + 1, max(i + 1, last[i]))
            first, own = by_width[wide[i]]
            differ = np.bitwise_count(own[i + 1 - first : some.stop - first] ^ own[i - first]).sum(axis=1, dtype=np.int64)
            meets = (roots[some] != roots[i]) & ((marks[some] != marks[i]) | (marks[i] < 0))
            found = np.flatnonzero(meets & (differ * (100 + percent) <= (sizes[some] + sizes[i]) * (100 - percent)))
            if best is not None and len(found) > best:
                found = found[np.argsort(differ[found], kind="stable")[:best]]
                more.append(1)
            if len(found):
                yield np.stack([np.maximum(nodes[found + i + 1], nodes[i]), np.minimum(nodes[found + i + 1], nodes[i])], axis=1)

    def run(batches):
        held, pairs, cut = None, [], []
        for rows in _columns(batches):
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            starts = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))
            held = [x[starts[-1] :] for x in rows]  # the last cell may go on
            for a, b in zip(starts, starts[1:]):
                pairs += region(more := [], *[x[a:b] for x in rows[1:]])
                cut += [int(rows[0][a])] if more else []
            if sum(map(len, pairs)) > GATHERED:
                pairs = [np.unique(np.concatenate(pairs), axis=0)]
                if len(pairs[0]) > GATHERED // 2:
                    yield out(pairs, cut)
                    pairs, cut = [], []
        if held is not None:
            pairs += region(more := [], *held[1:])
            cut += [int(held[0][0])] if more else []
        yield out(pairs, cut)

    def out(pairs, cut):
        both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        rows = [both[:, 0].tolist() + cut, both[:, 1].tolist() + [None] * len(cut)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=["a", "b"])

    cells = _cells(rows, LEAF).join(classes.select("node", "coarse"), "node").select("cell", "node", F.col("n").cast("long").alias("n"), "root", "mark", "coarse")
    return cells.repartition("cell").sortWithinPartitions("cell", "n", "node").mapInArrow(tidy(run), "a long, b long").distinct()


def _columns(batches) -> Iterator[list[np.ndarray]]:
    """The columns of each batch that has rows; binaries stay objects."""
    for batch in batches:
        if batch.num_rows:
            yield [column.to_numpy(zero_copy_only=False) for column in batch.columns]


def connected(classes: DataFrame, docs: DataFrame, first: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows (a, b): every node that is not the least of its component, with the least."""
    wide = max(0, 2 * percent - 100)  # twice the distance

    def close(pairs: DataFrame, percent: int) -> DataFrame:
        return compared(plausible(pairs, classes, percent), docs, classes, words, percent)

    roots = components(_links(close(first.filter("kind = 0").select("a", "b").distinct(), percent), percent))
    rows = first.filter("kind = 1").select("key", F.col("a").alias("node"), F.col("b").cast("int").alias("n"))
    alive = stored(_alive(rows, roots), "regions")
    rows, before = alive.filter(F.col("members") > LEAF).select("key", "node", "n"), None
    small = alive.filter(F.col("members") <= LEAF)
    for best in (BEST, None):
        found = stored(_leaves(small, classes, percent, best), "found")
        roots = components(roots.select("a", "b").unionByName(_links(close(found.filter("b is not null"), percent), percent)))
        if best:  # the cells with more partners, as far as they are not connected now
            cut = found.filter("b is null").select(F.col("a").alias("cell")).distinct()
            small = small.withColumn("cell", F.xxhash64("key", F.lit(0), F.lit(0))).join(cut, "cell", "left_semi")
            small = stored(_alive(small.select("key", "node", "n"), roots), "regions")
        if small.isEmpty():
            break
    while True:
        alive = stored(_alive(rows, roots), "regions")
        state = alive.agg(F.count("*"), F.max("members")).first()
        if not state[0]:
            return roots
        large = alive.filter(F.col("members") > LEAF)
        if state[1] <= LEAF or (before is not None and state[0] >= before):
            # Small enough, or so dense that windows take in nearly all: what is left is compared, large regions by a grid of blocks.
            return components(roots.select("a", "b").unionByName(_links(close(_leaves(alive, classes, percent, None).filter("b is not null"), percent), percent)))
        before = state[0]
        # Those outside the largest connected part come first: with them as pivots the rest is soon of one part.
        place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("root") == F.col("main"), "node"))
        chosen = large.withColumn("place", place).filter(F.col("place") <= F.greatest(F.lit(PIVOTS), F.col("members") / 64))
        pivots = stored(chosen.select("key", F.col("node").alias("pivot")), "pivots")
        met = large.select("key", "node").join(pivots, "key").filter("node <> pivot")
        pairs = met.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()
        near = stored(close(pairs, wide), "near")
        roots = components(roots.select("a", "b").unionByName(_links(near, percent)))
        rows = _cut(large, pivots, near, roots, percent).unionByName(alive.filter(F.col("members") <= LEAF).select("key", "node", "n"))


def _cut(large: DataFrame, pivots: DataFrame, near: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Each region as the regions of its pivots and the region of those in no core, without the pivots.

    A core holds the sets within e of the pivot that have none nearer, and is connected with it. Its window are the sets within 2 e that
    are not connected with it yet.
    """
    both = near.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "common", "whole").unionByName(
        near.select(F.col("b").alias("node"), F.col("a").alias("pivot"), "common", "whole"))
    left = large.select("key", "node", "n").join(pivots.withColumnRenamed("pivot", "node"), ["key", "node"], "left_anti")
    inside = stored(left.join(pivots, "key").join(both, ["node", "pivot"]), "inside")
    inner = inside.filter(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("whole"))
    core = stored(inner.groupBy("key", "node", "n").agg(F.max_by("pivot", F.struct(F.col("common") / F.col("whole"), "pivot")).alias("pivot")), "core")
    window = _rooted(_rooted(inside.select("key", "node", "n", "pivot"), roots), roots, "pivot", "home").filter("root <> home")
    rest = left.join(core.select("key", "node"), ["key", "node"], "left_anti")
    regions = core.unionByName(window.select("key", "node", "n", "pivot")).select(F.xxhash64("key", "pivot").alias("key"), "node", "n")
    return regions.unionByName(rest.select(F.xxhash64("key", F.lit(-1)).alias("key"), "node", "n"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, the size of its set, and the smallest id of its component."""
    ship(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("content"))
    printed = stored(prints(own, words), "prints")
    own_sets = printed.filter("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "digest")
    # A node is a set; of the texts that have it one is the node's.
    found = sets(own, frequent(printed), words, percent).filter("n > 0")
    found = found.groupBy("digest").agg(*[f(c).alias(c) for f, c in ((F.min, "content"), (F.min, "doc_id"), (F.first, "n"), (F.first, "fine"), (F.first, "coarse"), (F.first, "keys"))])
    classes = stored(found.withColumn("node", F.monotonically_increasing_id()), "classes")
    keys = regions(classes, percent).repartition("key").sortWithinPartitions("key", "node")
    first = stored(keys.mapInArrow(tidy(lambda batches: _stars(batches, percent)), "kind byte, key long, a long, b long"), "stars")
    roots = connected(classes.drop("keys"), own, first, words, percent)
    homes = classes.select("node", "digest", "doc_id").join(roots.withColumnRenamed("a", "node"), "node", "left").withColumn("root", F.coalesce("b", "node"))
    named = homes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    homes = homes.join(named, "root").select("digest", "component_id")
    lone = own_sets.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return own_sets.filter("n_shingles > 0").join(homes, "digest").select("doc_id", "n_shingles", "component_id").unionByName(lone)
