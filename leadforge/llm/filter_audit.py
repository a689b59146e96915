"""Audit of filters that are applied one after another: what each removes, alone and in every order.

Equal texts are found with radix tries. Texts are range-partitioned by prefixes that are as long as needed: prefixes whose texts are
too large together are counted again by longer ones, and neighbouring prefixes are packed to ranges of near equal bytes. Before the
shuffle each task inserts its texts into a compressed trie with the least id at each terminal. A document that is not the least of its
text there is a duplicate already and goes on as a narrow row, dealt out evenly; only the least one travels with its text. After the
shuffle a range's texts come sorted and go into a trie again, whose traversal tells the least document of each text from the
others. Every text is judged by the other filters once per trie. Labels are joined to the narrow rows; what is left are counts per
(part, mask of failed filters, labels), and all orders are worked out from those.

Both passes empty a trie that holds ``HELD`` bytes; after the shuffle only between two different texts.

Cases: a null text is empty, and equal to an empty one; a null source is the part of the empty string; a null id is never smaller
than another, and a row without one is no duplicate; rows that share id and text are no duplicates of each other; labels that
repeat an id count if one of them is 1; a document without label is neither good nor toxic; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadforge.llm.common import binary_text, guarded_broadcast, ship, stored, tidy

UPPER, INSIDE, MARKS = bytes(range(0x41, 0x5B)), bytes(range(0x80, 0xC0)), b"#$%&*|"
Rule = Callable[[bytes, list[bytes]], bool]
#: Each filter's rule over the UTF-8 text and its words; true where the text fails.
RULES: dict[str, Rule] = {
    "A": lambda text, words: len(words) < 200,
    "B": lambda text, words: 100 * len(set(words)) < 50 * len(words),
    "C": lambda text, words: 100 * (len(text) - len(text.translate(None, UPPER))) > 2 * len(text.translate(None, INSIDE)),
    "D": lambda text, words: len(text) != len(text.translate(None, MARKS)),
}
DUPLICATE = "E"
FIRST, LONGER = 8, 4  # bytes of the shortest prefixes; how much longer the next ones are
RANGE_BYTES, RANGES, HELD = 8 << 20, 10_000, 16 << 20


class Trie:
    """A radix trie over bytes: each node is [value, children], the children by first byte as (label, node)."""

    def __init__(self):
        self.root, self.held = [None, {}], 0

    def spot(self, text: bytes) -> list:
        """The text's node, inserted where it is new; its first item is the value."""
        node, at = self.root, 0
        while at < len(text):
            edge = node[1].get(text[at])
            if edge is None:
                node[1][text[at]] = (text[at:], leaf := [None, {}])
                self.held += len(text) - at + 200
                node = leaf
                break
            label, below = edge
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            same = common(label, text, at)
            middle = [None, {label[same]: (label[same:], below)}]
            node[1][text[at]] = (label[:same], middle)
            self.held += 200
            node, at = middle, at + same
        return node

    def items(self) -> Iterator[tuple[bytes, object]]:
        """All texts with their values."""
        pending = [((), self.root)]
        while pending:
            path, (value, children) = pending.pop()
            if value is not None:
                labels, step = [], path
                while step:
                    labels.append(step[1])
                    step = step[0]
                yield b"".join(reversed(labels)), value
            pending += [((path, label), node) for label, node in children.values()]


def common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of the label the text has at this place; found by halves."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


# Before the shuffle a terminal is [least id, mask, {part: documents with that id}]; after it, [least id, rows so far].

ROW = "text binary, doc_id long, part string, mask int, n long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.large_binary(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["text", "doc_id", "part", "mask", "n"])


def _sized(rows: Iterator[tuple], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of some megabytes."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[0] or b"") + 100
        if size > most:
            yield _batch(some)
            some, size = [], 0
    yield _batch(some)


def _collected(rules: dict[str, Rule], bit: int, batches) -> Iterator[tuple]:
    """Before the shuffle: the least document of each text with the text, all others without."""
    trie = Trie()
    for batch in batches:
        for text, doc, part in zip(*batch.columns):
            text, doc, part = text.as_py(), doc.as_py(), part.as_py()
            spot = trie.spot(text)
            if spot[0] is None:
                words = text.split()  # only ASCII white space cuts bytes
                spot[0] = [None, sum(1 << i for i, fails in enumerate(rules.values()) if fails(text, words)), {}]
            value = spot[0]
            if doc is None:
                yield None, None, part, value[1], 1
            elif value[0] is not None and doc > value[0]:
                yield None, doc, part, value[1] | bit, 1
            else:
                if doc != value[0]:
                    for other, n in value[2].items():
                        yield None, value[0], other, value[1] | bit, n
                    value[0], value[2] = doc, {}
                value[2][part] = value[2].get(part, 0) + 1
            if trie.held > HELD:
                yield from _least(trie)
                trie = Trie()
    yield from _least(trie)


def _least(trie: Trie) -> Iterator[tuple]:
    for text, (doc, mask, parts) in trie.items():
        for part, n in parts.items():
            yield text, doc, part, mask, n


def _told(bit: int, batches) -> Iterator[tuple]:
    """After the shuffle: every document without its text, with its duplicate flag; texts come sorted."""
    trie, last = Trie(), None
    for batch in batches:
        for text, doc, part, mask, n in zip(*batch.columns):
            text, row = text.as_py(), (doc.as_py(), part.as_py(), mask.as_py(), n.as_py())
            if text is None:
                yield None, *row
                continue
            if trie.held > HELD and text != last:  # what is in the trie is complete
                yield from _flagged(trie, bit)
                trie = Trie()
            spot, last = trie.spot(text), text
            if spot[0] is None:
                spot[0] = [row[0], []]
            spot[0][0] = min(spot[0][0], row[0])
            spot[0][1].append(row)
            trie.held += 100
    yield from _flagged(trie, bit)


def _flagged(trie: Trie, bit: int) -> Iterator[tuple]:
    for _, (least, rows) in trie.items():
        for doc, part, mask, n in rows:
            yield None, doc, part, mask | (bit if doc > least else 0), n


def bounds(texts: DataFrame, target: int = RANGE_BYTES, ranges: int = RANGES) -> list[bytes]:
    """Where the ranges of texts begin: prefixes, longer ones where short ones hold too much.

    At most some ``ranges`` of them, however much text there is; the driver holds one prefix per range, as Spark's range sort does.
    """
    rows, length, leaves = texts.select("text"), FIRST, []
    while True:
        prefix = F.substring("text", 1, length)
        seen = rows.groupBy(prefix.alias("prefix")).agg(
            F.sum(F.octet_length("text")).alias("bytes"), (F.min(F.xxhash64("text")) != F.max(F.xxhash64("text"))).alias("several"))
        seen = stored(seen, "prefixes")
        if length == FIRST:
            total = seen.agg(F.sum("bytes")).first()[0] or 0
            target = max(target, total // ranges)
        heavy = seen.filter((F.col("bytes") > target) & F.col("several"))
        leaves.append(seen.filter((F.col("bytes") <= target) | ~F.col("several")))
        n = heavy.count()
        if not n:
            break
        rows = rows.withColumn("prefix", prefix).join(guarded_broadcast(heavy.select("prefix"), n), "prefix", "left_semi").select("text")
        length *= LONGER
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)

    def cut(batches):
        held = None
        for batch in batches:
            found = []
            for prefix, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held is None or held + size > target:
                    found.append(prefix)
                    held = 0
                held += size
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["prefix"])

    packed = every.select("prefix", "bytes").repartitionByRange("prefix").sortWithinPartitions("prefix").mapInArrow(cut, "prefix binary")
    return sorted(bytes(r[0]) for r in packed.collect())


def masks(docs: DataFrame, labels: DataFrame, rules: dict[str, Rule] | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows (part, good, toxic, mask, n): how many documents of a part fail which filters; the last bit stands for duplicates."""
    rules = RULES if rules is None else rules
    bit, spark = 1 << len(rules), docs.sparkSession
    ship(spark)
    own = docs.select(binary_text(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"))
    starts = bounds(own)
    sent = spark.sparkContext.broadcast(starts)  # one prefix per range

    def collect(batches):
        for batch in _sized(_collected(rules, bit, batches)):
            at = [i % (len(sent.value) + 1) if x is None else bisect_right(sent.value, x) for i, x in enumerate(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "range"])

    rows = own.mapInArrow(tidy(collect), f"{ROW}, range int")
    ranged = rows.repartitionById(len(starts) + 1, F.col("range")).sortWithinPartitions("text").drop("range")
    flagged = ranged.mapInArrow(tidy(lambda batches: _sized(_told(bit, batches))), ROW)
    narrow = flagged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = narrow.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    return marked.groupBy("part", "good", "toxic", "mask").agg(F.sum("n").alias("n"))


def audit(counts: DataFrame, letters: str = "".join(RULES) + DUPLICATE) -> DataFrame:
    """Per part, order of the filters and step: documents kept, removed, redundantly failing, and the filter's share over all orders."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    steps = steps.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    before = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    bits = lambda among: sum((F.when(F.instr(among, x) > 0, 1 << i).otherwise(0) for i, x in enumerate(letters)), F.lit(0))
    bit = bits(F.col("letter"))
    fails, gone = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(bits(before)) != 0
    steps = steps.select("part", "filter_order", "step", "letter", "good", "toxic", "n", fails.alias("fails"), gone.alias("gone"), (F.col("mask") == bit).alias("only"))
    number = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0)).cast("long")
    here = F.col("fails") & ~F.col("gone")
    per_step = steps.groupBy("part", "filter_order", "step", "letter").agg(
        number(~F.col("fails") & ~F.col("gone")).alias("kept"), number(here).alias("removed"), number(F.col("fails") & F.col("gone")).alias("redundant"),
        number(F.col("only")).alias("unique_fails"), number(here & F.col("good")).alias("good_lost"), number(here & F.col("toxic")).alias("toxic_lost"))
    per_step = stored(per_step, "steps")
    shares = per_step.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return per_step.join(shares, ["part", "letter"]).drop("letter")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole texts."""
    return audit(stored(masks(docs, labels), "masks"))
