"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id.

1. *Runs.* Every window of ``LENGTH`` bytes is named by the smallest hash among its 16-byte grams. Equal windows have equal
   names, and neighbouring windows mostly share theirs, so a text falls into runs of windows of one name.
2. *Names.* The names of each split of documents are compared, as sorted arrays of hashes only. A name that one document
   alone has cannot repeat, and its windows are done with.
3. *Index.* The text of the remaining runs goes to the bucket of its name. A name with more than ``HOT_RUNS`` runs is a frequent
   gram in many contexts; its windows are dealt out one by one, by the hash of all their bytes. In a bucket, batches in the order of ids get a
   suffix array (their suffixes sorted, read up to ``LENGTH`` bytes), which is merge-scanned against the arrays of the levels
   before it; suffixes that no level holds form a new level, and levels of like size merge, so that sizes fall geometrically.
   Strings are compared byte by byte; hashes only decide what is compared.
4. *Cut.* The spans found come back to their documents.

Text that repeats wholly inside a split is settled there and its first copy alone travels, so that a passage in many
documents reaches a bucket once per split. Where there are more than ``FAN`` splits, buckets past ``LARGE_BUCKET`` bytes settle
it once more by groups of ``FAN`` splits.

Splits have bounded text by the hash of id and text that deals the rows out, so rows of one id, or without an id, are spread
like any others; owners are compared by id wherever they meet. Rows that agree in both would share a split: where they hold
more than a split's bytes, one row stands for them in all passes, and its result is joined to them at the end.

Cases: a null text is empty; texts shorter than ``LENGTH`` stay whole; rows of one id never remove each other's text; a null
id counts as the largest; an empty table gives no rows. Columns named in ``keep`` are carried along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm.common import binary_text, guarded_broadcast, ship, stored, tidy_group

LENGTH, GRAM = 50, 16
SPLIT_BYTES, BATCH_BYTES, BATCH_WINDOWS, LONGEST_RUN = 8 << 20, 1 << 18, 100_000, 64
HOT_RUNS, FAN, LARGE_BUCKET = 20_000, 4096, 16 << 20
LAST = np.iinfo(np.int64).max


def mix(x: np.ndarray, factor: int) -> np.ndarray:
    """Spreads 64-bit values: multiply, fold the high half down, multiply again."""
    x = x * np.uint64(factor)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM (16) bytes at each position, by doubling."""
    h, base = data.astype(np.uint64) + np.uint64(1), 0x100000001B3
    for step in (1, 2, 4, 8):
        h = h[:-step] * np.uint64(base) + h[step:]
        base = base * base % (1 << 64)
    return mix(h ^ (h >> np.uint64(29)), 0xD6E8FEB86659FD93)


def window_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of all LENGTH (50) bytes from each place on, from the grams that cover them."""
    grams, whole = gram_hashes(data), np.zeros(len(places), np.uint64)
    for step in (*range(0, LENGTH - GRAM, GRAM), LENGTH - GRAM):
        whole = mix(whole ^ grams[places + step], 0xC2B2AE3D27D4EB4F)
    return whole


def least_in_window(h: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[: len(h) - (width - reach)], h[width - reach :]) if width > reach else h


def runs(texts: list[bytes], length: int = LENGTH):
    """Yields (first text, joined bytes, text's starts, run's text, run's start in the joined bytes, windows, name)."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (held == 0 or held + len(texts[end]) <= BATCH_BYTES):
            held += len(texts[end])
            end += 1
        part = texts[at:end]
        joined = b"".join(part)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        stops = np.cumsum(sizes)
        if len(joined) >= length:
            data = np.frombuffer(joined, np.uint8)
            least = least_in_window(gram_hashes(data), length - GRAM + 1)
            owner = np.repeat(np.arange(len(part)), sizes)[: len(least)]
            valid = np.arange(len(least)) + length <= stops[owner]
            fresh = valid.copy()
            fresh[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
            places = np.flatnonzero(valid)
            first = np.flatnonzero(fresh[places])
            windows = np.diff(np.append(first, len(places)))
            starts = places[first]
            pieces = -(-windows // LONGEST_RUN)
            if (pieces > 1).any():  # periodic text: one name for very many windows
                turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                windows = np.minimum(np.repeat(windows, pieces) - turn * LONGEST_RUN, LONGEST_RUN)
                starts = np.repeat(starts, pieces) + turn * LONGEST_RUN
            yield at, joined, stops - sizes, owner[starts], starts, windows, mix(least[starts], 0xA0761D6478BD642F)
        at = end


def ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """A split's rows in the order of ids, then texts, so that a row's place names it in every pass; ids; texts."""
    table = table.take(pc.sort_indices(table, sort_keys=[("__id", "ascending"), ("__data", "ascending")]))
    ids = table.column("__id").fill_null(LAST).to_numpy()
    return table, ids, table.column("__data").to_pylist()


def names(table: pa.Table, buckets: int, low_bits: int = 32) -> pa.Table:
    """The distinct names of a split by bucket: sorted low halves, a mark at those that several ids have, and
    the logarithm of each name's runs."""
    split = table.column("__split")[0].as_py()
    _, ids, texts = ordered(table)
    found = [(name, ids[at + owner]) for at, _, _, owner, _, _, name in runs(texts)]
    if not found:
        return pa.table({"bucket": pa.array([], pa.int32()), "split": pa.array([], pa.int32()), "low": pa.array([], pa.binary()), "many": pa.array([], pa.binary()), "times": pa.array([], pa.binary())})
    name = np.concatenate([f[0] for f in found]) >> np.uint64(64 - low_bits - int(math.log2(buckets)))
    owner = np.concatenate([f[1] for f in found])
    order = np.argsort(name, kind="stable")
    name, owner = name[order], owner[order]
    heads = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    many = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
    times = np.ceil(np.log2(np.diff(np.append(heads, len(name))))).astype(np.uint8)
    name = name[heads]
    edges = np.searchsorted(name, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(low_bits))
    low = (name & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    filled = np.flatnonzero(np.diff(edges))
    return pa.table({
        "bucket": pa.array(filled, pa.int32()), "split": pa.array(np.full(len(filled), split), pa.int32()),
        "low": pa.array([low[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary()),
        "many": pa.array([np.packbits(many[edges[b] : edges[b + 1]]).tobytes() for b in filled], pa.binary()),
        "times": pa.array([times[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary()),
    })


def shared_names(table: pa.Table, hot_runs: int = HOT_RUNS) -> pa.Table:
    """Of a bucket of names, those of each split that another split or several ids of one split have as well; marks at hot ones."""
    lows = [np.frombuffer(x, np.uint32) for x in table.column("low").to_pylist()]
    sizes = np.array([len(x) for x in lows])
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column("many").to_pylist(), sizes)])
    times = 1 << np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint8).astype(np.int64)
    low = np.concatenate(lows)
    order = np.argsort(low, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], low[order][1:] != low[order][:-1]]))
    count = np.diff(np.append(heads, len(low)))
    wide = (count > 1) | (np.maximum.reduceat(many[order], heads) > 0)
    kept, hot = np.empty(len(low), bool), np.empty(len(low), bool)
    kept[order] = np.repeat(wide, count)
    hot[order] = np.repeat(np.add.reduceat(times[order], heads) > hot_runs, count)
    ends = np.cumsum(sizes)
    blobs = pa.array([low[e - n : e][kept[e - n : e]].tobytes() for e, n in zip(ends, sizes)], pa.binary())
    marks = pa.array([np.packbits(hot[e - n : e][kept[e - n : e]]).tobytes() for e, n in zip(ends, sizes)], pa.binary())
    found = pa.table({"bucket": table.column("bucket"), "split": table.column("split"), "low": blobs, "hot": marks})
    return found.filter(pc.greater(pc.binary_length(blobs), 0))


def pack(*arrays: np.ndarray, text: bytes = b"") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.int64(len(arrays[0])).tobytes(), *[a.astype(np.int64).tobytes() for a in arrays], text]))


def unpack(blob: bytes, arrays: int) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    numbers = np.frombuffer(raw, np.int64, n * arrays, 8).reshape(arrays, n)
    return list(numbers), raw[8 + 8 * n * arrays :]


def candidates(table: pa.Table, shared: pa.Table, name_buckets: int, buckets: int) -> pa.Table:
    """The runs of a split under shared names: text to the name's bucket, or a settled span where an earlier id in the
    split has the very same run. Rows of kind 0 are settled spans, of kind 1 text."""
    empty = pa.table({"bucket": pa.array([], pa.int32()), "split": pa.array([], pa.int32()), "kind": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
    if not len(table) or not len(shared):
        return empty
    split = table.column("__split")[0].as_py()
    _, ids, texts = ordered(table)
    wanted = np.concatenate([np.uint64(b << 32) | np.frombuffer(x, np.uint32).astype(np.uint64) for b, x in zip(shared.column("bucket").to_pylist(), shared.column("low").to_pylist())])
    hot = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(x) // 4) for m, x in zip(shared.column("hot").to_pylist(), shared.column("low").to_pylist())]) > 0
    order = np.argsort(wanted)
    wanted, hot = wanted[order], hot[order]
    shift = np.uint64(64 - 32 - int(math.log2(name_buckets)))
    first: dict[bytes, int] = {}
    settled: list[tuple[int, int, int]] = []
    send: dict[int, list] = {}
    for at, joined, begins, owner, starts, windows, name in runs(texts):
        short = name >> shift
        place = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
        hit = np.flatnonzero(wanted[place] == short)
        key, owner, starts, windows, single = name[hit], owner[hit], starts[hit], windows[hit], hot[place[hit]]
        if single.any():  # a hot name's windows travel one by one
            n = np.where(single, windows, 1)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key, owner, starts, windows, single = (np.repeat(x, n) for x in (key, owner, starts, windows, single))
            starts, windows = starts + step, np.where(single, 1, windows)
            key[single] = window_hashes(np.frombuffer(joined, np.uint8), starts[single])
        home = (mix(key, 0xE7037ED1A0B428DB) >> np.uint64(32)) % np.uint64(buckets)
        row = at + owner
        for r, d, s, a, w, h in zip(row.tolist(), ids[row].tolist(), starts.tolist(), begins[owner].tolist(), windows.tolist(), home.tolist()):
            text = joined[s : s + w + LENGTH - 1]
            seen = first.setdefault(text, d)
            if seen < d:
                settled.append((r, s - a, s - a + w + LENGTH - 1))
            else:
                send.setdefault(h, []).append((d, r, s - a, w, text))
    rows = [(b, 1, pack(*np.array([x[:4] for x in found], np.int64).T, text=b"".join(x[4] for x in found))) for b, found in send.items()]
    if settled:
        rows.append((split % buckets, 0, pack(*np.array(settled, np.int64).T)))
    return pa.table({
        "bucket": pa.array([r[0] for r in rows], pa.int32()), "split": pa.array([split] * len(rows), pa.int32()),
        "kind": pa.array([r[1] for r in rows], pa.int32()), "blob": pa.array([r[2] for r in rows], pa.binary()),
    })


def settle(table: pa.Table) -> pa.Table:
    """A bucket's text from a group of splits: of equal runs only those of the smallest id stay, the others are settled spans."""
    parts = [(s, *unpack(b, 4)) for s, b in zip(table.column("split").to_pylist(), table.column("blob").to_pylist())]
    bucket, first, seen = table.column("bucket")[0].as_py(), {}, []
    for split, (owner, row, start, windows), text in parts:
        ends = np.cumsum(windows + LENGTH - 1)
        for d, r, s, w, e in zip(owner.tolist(), row.tolist(), start.tolist(), windows.tolist(), ends.tolist()):
            run = text[e - w - LENGTH + 1 : e]
            seen.append((split, d, r, s, w, run))
            first[run] = min(first.get(run, d), d)
    send: dict[int, list] = {}
    settled: dict[int, list] = {}
    for split, d, r, s, w, run in seen:
        if first[run] < d:
            settled.setdefault(split, []).append((r, s, s + w + LENGTH - 1))
        else:
            send.setdefault(split, []).append((d, r, s, w, run))
    rows = [(x, 1, pack(*np.array([f[:4] for f in found], np.int64).T, text=b"".join(f[4] for f in found))) for x, found in send.items()]
    rows += [(x, 0, pack(*np.array(found, np.int64).T)) for x, found in settled.items()]
    return pa.table({
        "bucket": pa.array([bucket] * len(rows), pa.int32()), "split": pa.array([r[0] for r in rows], pa.int32()),
        "kind": pa.array([r[1] for r in rows], pa.int32()), "blob": pa.array([r[2] for r in rows], pa.binary()),
    })


def settled_once_more(sent: DataFrame, splits: int, fan: int, large_bucket: int) -> DataFrame:
    """``sent`` with equal runs of the large buckets settled by groups of splits; spans that are settled go home another way."""
    sent = stored(sent, "runs")
    sizes = sent.filter("kind = 1").groupBy("bucket").agg(F.sum(F.octet_length("blob")).alias("bytes"))
    large = stored(sizes.filter(F.col("bytes") > large_bucket).select("bucket", F.lit(True).alias("large")), "large")
    marked = sent.join(guarded_broadcast(large, large.count()), "bucket", "left")
    through = marked.filter("large and kind = 1").drop("large")
    group = F.floor(F.col("split") / max(fan, math.ceil(math.sqrt(splits))))
    again = through.groupBy("bucket", group.alias("group")).applyInArrow(tidy_group(settle), "bucket int, split int, kind int, blob binary")
    # Spans need no bucket of their own, so they do not fill the large one.
    away = F.when(F.col("kind") == 0, F.col("split")).otherwise(F.col("bucket")).alias("bucket")
    return marked.filter("large is null or kind = 0").drop("large").unionByName(again.select(away, "split", "kind", "blob"))


class Family:
    """Suffix arrays of geometrically falling size: sorted strings of LENGTH bytes, each with the smallest id it starts in."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, strings: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """The smallest id, up to now, of each of the batch's suffixes; ids may not fall from batch to batch."""
        order = np.argsort(strings, kind="stable")
        array, owner = strings[order], owners[order]
        heads = np.flatnonzero(np.concatenate([[True], array[1:] != array[:-1]]))
        mine, least = array[heads], np.minimum.reduceat(owner, heads)
        known = np.zeros(len(mine), bool)
        for level, ids in self.levels:
            place = np.minimum(np.searchsorted(level, mine), len(level) - 1)
            met = level[place] == mine
            least[met] = np.minimum(least[met], ids[place[met]])
            known |= met
        out = np.empty(len(strings), np.int64)
        out[order] = np.repeat(least, np.diff(np.append(heads, len(array))))
        fresh = (mine[~known], least[~known])
        while self.levels and len(self.levels[-1][0]) <= 2 * len(fresh[0]):
            older = self.levels.pop()
            both, ids = np.concatenate([older[0], fresh[0]]), np.concatenate([older[1], fresh[1]])
            merged = np.argsort(both, kind="stable")  # two sorted arrays: the stable sort merges them
            fresh = both[merged], ids[merged]
        if len(fresh[0]):
            self.levels.append(fresh)
        return out


def match(table: pa.Table) -> pa.Table:
    """The spans of a bucket's runs that start in a document with a smaller id, and the settled spans that pass through."""
    kinds, splits, blobs = (table.column(c).to_pylist() for c in ("kind", "split", "blob"))
    out = {"split": [s for k, s in zip(kinds, splits) if k == 0], "blob": [b for k, b in zip(kinds, blobs) if k == 0]}
    parts = [(s, *unpack(b, 4)) for k, s, b in zip(kinds, splits, blobs) if k == 1]
    if parts:
        split = np.concatenate([np.full(len(p[1][0]), p[0]) for p in parts])
        owner, row, start, windows = (np.concatenate([p[1][i] for p in parts]) for i in range(4))
        data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        sizes = windows + LENGTH - 1
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(owner, kind="stable")
        view, family, spans = np.lib.stride_tricks.sliding_window_view(data, LENGTH), Family(), []
        upto = np.cumsum(windows[order])
        at = 0
        while at < len(order):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH_WINDOWS, "right")))
            runs_ = order[at:end]
            n = windows[runs_]
            run = np.repeat(runs_, n)
            step = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
            strings = np.ascontiguousarray(view[begin[run] + step]).view(f"S{LENGTH}").ravel()
            taken = family.add(strings, owner[run]) < owner[run]
            # Windows taken side by side in a run become one span.
            edge = taken.copy()
            edge[1:] &= ~(taken[:-1] & (run[1:] == run[:-1]))
            stop = taken.copy()
            stop[:-1] &= ~(taken[1:] & (run[1:] == run[:-1]))
            a, b = np.flatnonzero(edge), np.flatnonzero(stop)
            spans.append(np.stack([split[run[a]], row[run[a]], start[run[a]] + step[a], start[run[a]] + step[b] + LENGTH]))
            at = end
        split, row, start, end = np.concatenate(spans, axis=1)
        by = np.argsort(split, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(split[by])) + 1) if len(by) else []:
            out["split"].append(int(split[part[0]]))
            out["blob"].append(pack(row[part], start[part], end[part]))
    return pa.table({"split": pa.array(out["split"], pa.int32()), "blob": pa.array(out["blob"], pa.binary())})


def merged_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal removed runs per row: (first of each row, starts, ends). Spans that touch are one."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return np.zeros(rows + 1, np.int64), start, end
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + row * wide)  # rows follow each other, so one running maximum serves all
    fresh = np.concatenate([[True], (start + row * wide)[1:] > reach[:-1]])
    fresh[1:] |= row[1:] != row[:-1]
    heads = np.flatnonzero(fresh)
    lasts = np.append(heads[1:], len(row)) - 1
    return np.searchsorted(row[heads], np.arange(rows + 1)), start[heads], (reach - row * wide)[lasts]


def cut(table: pa.Table, spans: pa.Table, keep: list[str], marked: bool = False) -> pa.Table:
    """The rows of a split with their removed runs and the bytes that stay; ``marked`` ones as they came in, the text only of
    those that stand for many."""
    table, _, texts = ordered(table)
    parts = [unpack(b, 3)[0] for b in spans.column("blob").to_pylist()]
    row, start, end = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
    first, start, end = merged_spans(row, start, end, len(texts))
    kept, pairs = [], []
    for i, text in enumerate(texts):
        mine = list(zip(start[first[i] : first[i + 1]].tolist(), end[first[i] : first[i + 1]].tolist()))
        pieces, at = [], 0
        for a, b in mine:
            pieces.append(text[at:a])
            at = b
        kept.append(b"".join([*pieces, text[at:]]) if mine else text)
        pairs.append([{"start": a, "end": b} for a, b in mine])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    found = {"n_bytes": pa.array([len(t) for t in texts], pa.int64()), "spans": pa.array(pairs, kind), "kept": pa.array(kept, pa.binary())}
    if not marked:
        return pa.table({**{c: table.column(f"k_{c}") for c in keep}, **found})
    many = table.column("__many").to_pylist()
    data = pa.array([t if m else None for t, m in zip(texts, many)], pa.binary())
    return pa.table({"__key": table.column("__key"), "__id": table.column("__id"), "__data": data, "__many": table.column("__many"), **{f"k_{c}": table.column(f"k_{c}") for c in keep}, **found})


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",), split_bytes: int = SPLIT_BYTES,
          hot_runs: int = HOT_RUNS, fan: int = FAN, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """Per document the columns in ``keep``, its bytes, the removed runs (start, end) and the bytes kept."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("__id"), binary_text(text).alias("__data"), *[F.col(c).alias(f"k_{c}") for c in keep],
    ).withColumn("__key", F.xxhash64("__id", "__data"))
    sizes = rows.groupBy("__key").agg(F.sum(F.octet_length("__data")).alias("bytes"), F.count("*").alias("n"))
    sizes = stored(sizes, "sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    splits = max(1, math.ceil(total / split_bytes))
    name_buckets = 1 << max(6, math.ceil(math.log2(max(1, splits // 2))))
    buckets = max(8, 2 * splits)
    large = sizes.filter((F.col("n") > 1) & (F.col("bytes") > split_bytes)).select("__key")
    copied = large.count()
    if copied:
        large = guarded_broadcast(large, copied)
        copies = rows.join(large, "__key", "left_semi")
        one = copies.select("__key", "__id", "__data").distinct()
        stand_in = one.select("__id", "__data", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"k_{c}") for c in keep], "__key", F.lit(True).alias("__many"))
        rows = rows.join(large, "__key", "left_anti").select("__id", "__data", *[f"k_{c}" for c in keep], "__key", F.lit(False).alias("__many")).unionByName(stand_in)
    else:
        rows = rows.withColumn("__many", F.lit(False))
    base = rows.withColumn("__split", F.pmod("__key", F.lit(splits)).cast("int")).repartition(splits, "__split")
    # The same exchange of texts serves all three passes over them.
    listed = base.groupBy("__split").applyInArrow(tidy_group(lambda t: names(t, name_buckets)), "bucket int, split int, low binary, many binary, times binary")
    shared = listed.repartition(name_buckets, "bucket").groupBy("bucket").applyInArrow(tidy_group(lambda t: shared_names(t, hot_runs)), "bucket int, split int, low binary, hot binary")
    sent = base.groupBy("__split").cogroup(shared.groupBy("split")).applyInArrow(tidy_group(lambda t, s: candidates(t, s, name_buckets, buckets)), "bucket int, split int, kind int, blob binary")
    if splits > fan:
        sent = settled_once_more(sent, splits, fan, large_bucket)
    spans = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(tidy_group(match), "split int, blob binary")
    kinds = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    found = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    results = [T.StructField("n_bytes", T.LongType()), T.StructField("spans", found), T.StructField("kept", T.BinaryType())]
    if not copied:
        return base.groupBy("__split").cogroup(spans.groupBy("split")).applyInArrow(tidy_group(lambda t, s: cut(t, s, list(keep))), T.StructType([*kinds, *results]))
    marks = [T.StructField("__key", T.LongType()), T.StructField("__id", T.LongType()), T.StructField("__data", T.BinaryType()), T.StructField("__many", T.BooleanType())]
    names_of = [f"k_{c}" for c in keep]
    wide = T.StructType([*marks, *[T.StructField(n, k.dataType) for n, k in zip(names_of, kinds)], *results])
    done = stored(base.groupBy("__split").cogroup(spans.groupBy("split")).applyInArrow(tidy_group(lambda t, s: cut(t, s, list(keep), marked=True)), wide), "cut")
    shown = [*[F.col(n).alias(c) for n, c in zip(names_of, keep)], "n_bytes", "spans", "kept"]
    one = done.filter("__many").select("__key", F.col("__id").alias("__id_one"), F.col("__data").alias("__data_one"), "n_bytes", "spans", "kept")
    same = (F.col("__data") == F.col("__data_one")) & F.col("__id").eqNullSafe(F.col("__id_one"))
    # The copies of one row can be many: Spark's join splits their side.
    return done.filter("not __many").select(*shown).unionByName(copies.join(one, "__key").filter(same).select(*shown))


def removed(docs: DataFrame) -> DataFrame:
    """One row per document: its bytes, the bytes and runs removed, and the digest of the bytes that stay."""
    return dedup(docs).select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
