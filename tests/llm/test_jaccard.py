"""The Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from llm_plain import rows_of
from leadforge.llm import jaccard

DOCS = "doc_id long, text string, n int, key string, node long"


def plain(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    own = []
    for _, text, *_ in rows:
        words = (text or "").encode().lower().split()
        own.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j]):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((r[0], len(own[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def documents(seed=6):
    rng = random.Random(seed)
    prose = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]

    def edited(words, times):
        words = list(words)
        for _ in range(times):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        return words

    texts = [None, "", " \t", "One", "one", "two words", "A b C d", "a b c d", "a b c d e", "a b c d e f", "a b c d e g", "é ß İ x y z", "é SS i x y z"]
    passage = prose(60)
    for n in (30, 60, 200):
        base = prose(n)
        texts += [" ".join(edited(base, rng.randrange(1 + n // 25))) for _ in range(25)]
    texts += [" ".join(prose(30) + passage + prose(200)) for _ in range(15)]  # one passage, nothing else in common
    chain = prose(120)
    for i in range(40):  # each close to the next, the last far from the first
        texts.append(" ".join(chain))
        chain = edited(chain, 1)
    texts += [" ".join(prose(rng.randrange(1, 40))) for _ in range(40)] + ["z " * 4000, "z " * 3000, " ".join(prose(4000))]
    rng.shuffle(texts)
    rows = [(1000 - i, t, 0, "k", 1) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, rows[7][1], 0, "k", 1), (None, "nobody else has this text", 0, "k", 1), (3, rows[9][1], 0, "k", 1)]


@pytest.mark.parametrize("leaf, pivots, block, often", [(1024, 16, 200_000, 65_536), (3, 2, 150, 0)])
def test_components_by_brute_force(spark, monkeypatch, leaf, pivots, block, often):
    for name, value in (("LEAF", leaf), ("PIVOTS", pivots), ("BLOCK", block), ("FREQUENT", often)):
        monkeypatch.setattr(jaccard, name, value)
    rows = documents()
    assert rows_of(jaccard.near_duplicates(spark.createDataFrame(rows, DOCS))) == plain(rows)


def test_nothing(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    lone = spark.createDataFrame([(1, None, 0, "", 1), (2, " ", 0, "", 1)], DOCS)
    assert rows_of(jaccard.near_duplicates(lone)) == [(1, 0, 1), (2, 0, 2)]


def test_bounds_never_drop_a_link():
    """Sets that are just close enough pass both bounds, and meet in a region."""
    rng = random.Random(3)
    for _ in range(300):
        whole = np.unique(np.array([rng.randrange(2**64) for _ in range(rng.randrange(5, 400))], np.uint64))
        common = -(-80 * len(whole) // 100)
        cut = rng.randrange(len(whole) - common + 1)
        order = rng.sample(range(len(whole)), len(whole))
        a, b = (np.sort(whole[sorted(order[:common] + part)]) for part in (order[common : common + cut], order[common + cut :]))
        for per in (1, jaccard.FINE):
            assert jaccard.apart(jaccard.parities(a, per).tobytes(), jaccard.parities(b, per).tobytes()) * 180 <= (len(a) + len(b)) * 20
        first = [set(x[: len(x) - jaccard.overlap(len(x), 80) + 1].tolist()) for x in (a, b)]
        assert first[0] & first[1]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_regions_that_span_batches(size):
    rng = random.Random(size)
    rows = sorted((rng.randrange(30), node, rng.choice([100, 110, 300])) for node in range(120))
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + size]), (pa.int64(), pa.int64(), pa.int32()))], names=["key", "node", "n"]) for i in range(0, len(rows), size)]
    got = sorted(tuple(r.values()) for batch in jaccard._stars(iter(batches), 80) for r in batch.to_pylist())
    want = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        want += [(0, key, r[1], own[0][1]) for r in own[1:] if min(r[2], own[0][2]) >= 0.8 * max(r[2], own[0][2])]
        want += [(1, key, r[1], r[2]) for r in own[1:] if len(own) >= 3]
    assert got == sorted(want)
