"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned vector; learned filters over 8 bytes run along the document in steps of 4. Chunks of 256 bytes,
overlapping by a step so that no window is lost between them, are max-pooled per filter. A learned layer turns the mean
over the document's chunks into one probability. All bytes of a document are read, whatever its length.

The network is trained on the whole texts of a bounded sample: of the rows that may be learned from, the ``sample`` with the
smallest hash of their id, in that order and as many as ``held`` bytes of text have room for. A text that alone has more
bytes is not learned from. The sample's order and the random start are fixed, so reruns agree.

Cases: a null text is scored like an empty one, as a single chunk without letters; labels other than 0 and 1 and labels of
unknown documents are not learned; without labels every score is 0.5. Rows that repeat an id are scored each, and learned
from once per label, by their smallest text, so that an id of very many rows brings no more to the driver. Extra columns are kept by ``score`` and never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm.common import ship, stored, tidy

STEP, CHUNK, WIDTH, FILTERS = 4, 256, 8, 32
SAMPLE, HELD, EPOCHS, BATCH, RATE, SEED = 4000, 16 << 20, 10, 32, 0.01, 5
PER_CHUNK = CHUNK // STEP


def held_out(doc_id: str | Column) -> Column:
    """Whether a row is kept back from learning: the remainder by 3 of the checksum of its id as text is 1."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in blocks of a step, each document followed by a block of zeros; chunk starts and chunks per document."""
    blocks = np.array([max(1, -(-len(t) // STEP)) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(blocks + 1)])
    data = np.zeros(first[-1] * STEP, np.uint8)
    for text, at in zip(texts, first[:-1] * STEP):
        data[at : at + len(text)] = np.frombuffer(text, np.uint8)
    chunks = -(-blocks // PER_CHUNK)
    inside = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return data.reshape(-1, STEP), np.repeat(first[:-1], chunks) + inside * PER_CHUNK, chunks


class Network:
    """Parameters, forward pass and training."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = STEP * WIDTH
        self.table = rng.normal(0, 0.5, (256, WIDTH)).astype(np.float32)
        self.now = rng.normal(0, (2 * size) ** -0.5, (size, FILTERS)).astype(np.float32)
        self.next = rng.normal(0, (2 * size) ** -0.5, (size, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.head = rng.normal(0, FILTERS**-0.5, FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def names(self):
        return ("table", "now", "next", "shift", "head", "bias")

    def _windows(self, blocks: np.ndarray):
        x = self.table[blocks.ravel()].reshape(len(blocks), -1)
        out = x @ self.now
        out[:-1] += x[1:] @ self.next
        out += self.shift
        return x, np.maximum(out, 0)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean over chunks of the max-pooled filters. The block of zeros behind a document belongs to its last chunk."""
        blocks, starts, chunks = lay_out(texts)
        _, out = self._windows(blocks)
        peaks = np.maximum.reduceat(out, starts, axis=0)
        return np.add.reduceat(peaks, np.cumsum(chunks) - chunks, axis=0) / chunks[:, None]

    def score(self, texts: list[bytes], most: int = 1 << 18) -> np.ndarray:
        """Probabilities; texts go through in groups of about ``most`` bytes, longer ones in pieces of whole chunks."""
        sums, counts = np.zeros((len(texts), FILTERS)), np.zeros(len(texts))
        group, owners, held = [], [], 0

        def flush():
            nonlocal group, owners, held
            if group:
                chunks = np.maximum(1, [-(-len(t) // CHUNK) for t in group])
                # A piece inside a text carries a step of the next one; it is a chunk's overlap, not a chunk.
                chunks = np.array([max(1, (len(t) - STEP) // CHUNK) if inner else c for t, c, (_, inner) in zip(group, chunks, owners)])
                np.add.at(sums, [o for o, _ in owners], self._piece_sums(group, [inner for _, inner in owners]))
                np.add.at(counts, [o for o, _ in owners], chunks)
            group, owners, held = [], [], 0

        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text)), most):
                inner = at + most < len(text)
                piece = text[at : at + most + STEP * inner]
                group.append(piece)
                owners.append((i, inner))
                held += len(piece)
                if held >= most:
                    flush()
        flush()
        return 1 / (1 + np.exp(-(sums / counts[:, None] @ self.head + self.bias[0])))

    def _piece_sums(self, pieces: list[bytes], inner: list[bool]) -> np.ndarray:
        """Sums of the chunks' peaks per piece; the overlap behind an inner piece only completes its last window."""
        blocks, starts, chunks = lay_out(pieces)
        _, out = self._windows(blocks)
        ends = np.cumsum(chunks)
        drop = np.zeros(len(starts), bool)
        drop[ends[np.array(inner, bool)] - 1] = True  # the overlap's own chunk
        peaks = np.maximum.reduceat(out, starts, axis=0)
        peaks[drop] = 0
        return np.add.reduceat(peaks, ends - chunks, axis=0)

    def train(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> "Network":
        """Adam on the logistic loss; the rarer class weighs more, by the root of the ratio."""
        rng, tick = np.random.default_rng(seed + 1), 0
        share = float(np.clip(labels.mean(), 0.01, 0.99))
        weight = np.where(labels == 1, (1 - share) ** 0.5, share**0.5)
        weight = weight / weight.mean()
        moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in self.names()}
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                pick, tick = order[at : at + BATCH], tick + 1
                for name, gradient in self._gradients([texts[i] for i in pick], labels[pick], weight[pick]).items():
                    first, second = moments[name]
                    first += 0.1 * (gradient - first)
                    second += 0.001 * (gradient * gradient - second)
                    getattr(self, name)[...] -= rate * (first / (1 - 0.9**tick)) / (np.sqrt(second / (1 - 0.999**tick)) + 1e-8)
        return self

    def _gradients(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray, most: int = 1 << 19) -> dict[str, np.ndarray]:
        """Long batches go through in groups of about ``most`` bytes, forward for the means and once more for the gradients."""
        groups, counts = list(grouped(texts, most)), np.array([max(1, -(-len(t) // CHUNK)) for t in texts])
        sums = np.zeros((len(texts), FILTERS), np.float32)
        for group in groups:
            forward = self._peaks(group)
            np.add.at(sums, forward[-1], forward[-2])
        mean = sums / counts[:, None]
        error = ((1 / (1 + np.exp(-(mean @ self.head + self.bias[0]))) - labels) * weight / len(texts)).astype(np.float32)
        total = {"head": (error @ mean).astype(np.float32), "bias": error.sum(keepdims=True)}
        for group in groups:
            blocks, x, out, where, peaks, owner = self._peaks(group) if len(groups) > 1 else forward
            d_peaks = (error / counts)[owner][:, None] * self.head * (peaks > 0)
            d_out = np.zeros_like(out)
            np.add.at(d_out, (where, np.broadcast_to(np.arange(FILTERS), where.shape)), d_peaks)
            d_x = d_out @ self.now.T
            d_x[1:] += d_out[:-1] @ self.next.T
            d_table = np.zeros_like(self.table)
            used = np.flatnonzero(d_x.any(axis=1))
            np.add.at(d_table, blocks[used].ravel(), d_x[used].reshape(-1, WIDTH))
            for name, part in (("shift", d_out.sum(axis=0)), ("now", x.T @ d_out), ("next", x[1:].T @ d_out[:-1]), ("table", d_table)):
                total[name] = total[name] + part if name in total else part
        return total

    def _peaks(self, group: list[tuple[int, bool, bytes]]):
        """Blocks, vectors, filters, and per chunk the place and value of each filter's peak and the chunk's text. An overlap's
        own chunk has peaks of zero, which learn nothing."""
        blocks, starts, chunks = lay_out([piece for _, _, piece in group])
        x, out = self._windows(blocks)
        ends = np.append(starts[1:], len(blocks))
        place = np.minimum(starts[:, None] + np.arange(int((ends - starts).max())), ends[:, None] - 1)
        grid = out[place]
        where, peaks = np.take_along_axis(place, grid.argmax(axis=1), axis=1), grid.max(axis=1)
        peaks[np.cumsum(chunks)[[inner for _, inner, _ in group]] - 1] = 0
        return blocks, x, out, where, peaks, np.repeat([i for i, _, _ in group], chunks)


def grouped(texts: list[bytes], most: int):
    """Lists of (text's place, whether the text goes on, bytes) of about ``most`` bytes; longer texts are cut at whole chunks, and
    a piece carries a step of the next one."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text)), most):
            inner = at + most < len(text)
            piece = text[at : at + most + STEP * inner]
            if group and held + len(piece) > most:
                yield group
                group, held = [], 0
            group.append((i, inner, piece))
            held += len(piece)
    yield group


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, held: int = HELD, **options) -> Network | None:
    """The trained network; None without labels. Only rows that are not held out are learned from."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(F.col(doc_id).alias("__id"), F.col(label).alias("__label"))
    # Labels of unknown documents take no place in the sample.
    present = docs.select(F.col(doc_id).alias("__id")).filter(F.col("__id").isNotNull()).distinct()
    chosen = known.distinct().join(present, "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample)
    rows = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text")).join(F.broadcast(chosen), "__id")  # at most ``sample`` rows

    rows = rows.groupBy("__id", "__label").agg(F.min("__text").alias("__text"))
    rows = rows.select(F.col("__id").cast("long").alias("id"), F.col("__text").cast("binary").alias("text"), F.col("__label").cast("int").alias("label"))
    place = F.struct(F.xxhash64("id"), "id", "label")
    rows = stored(rows.filter(F.octet_length("text") <= held).withColumn("place", place), "learned")
    last, room = None, held
    for place, size in sorted(tuple(r) for r in rows.select("place", F.octet_length("text")).collect()):  # at most ``sample`` rows
        room -= size
        if room < 0:
            break
        last = place
    chosen = rows.filter(F.col("place") <= F.struct(*[F.lit(x) for x in last]).cast(rows.schema["place"].dataType)) if last else rows.limit(0)
    found = sorted(tuple(r) for r in chosen.select("id", "text", "label").collect())
    if not found:
        return None
    return Network().train([bytes(r[1]) for r in found], np.array([r[2] for r in found], np.float32), **options)


def score(docs: DataFrame, network: Network | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is of label 1."""
    if network is None:
        return docs.withColumn(out, F.lit(0.5))
    ship(docs.sparkSession)
    kept = docs.drop(out)
    place, names = kept.columns.index(text), [*kept.columns, out]
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches):
        for batch in batches:
            found = np.zeros(len(batch))
            for at in range(0, len(batch), 256):  # copies of a few texts at a time
                texts = [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in batch.column(place)[at : at + 256]]
                found[at : at + 256] = network.score(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=names)

    # Under plain names, as any name of a column will do.
    return kept.toDF(*[f"__kept_{i}" for i in range(len(kept.columns))]).mapInArrow(tidy(run), schema)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether it is held out, its score and the label it is taken for."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
