"""The filter audit against plain counting, and its tries."""

import random
from itertools import permutations

import pytest

from llm_plain import rows_of
from leadforge.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, mask int, good string"
LABELS = "doc_id long, quality int, toxic int, part string"


def plain(rows, labels):
    masks = []
    for doc, text, source, *_ in rows:
        text = text or ""
        words = text.encode().split()
        smaller = any(d is not None and doc is not None and d < doc and (t or "") == text for d, t, *_ in rows)
        upper = sum("A" <= c <= "Z" for c in text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * upper > 2 * len(text), "D": any(c in "#$%&*|" for c in text), "E": smaller}
        own = [lab for lab in labels if lab[0] == doc and doc is not None]
        masks.append((source or "", {f for f, bad in fails.items() if bad}, any(lab[1] == 1 for lab in own), any(lab[2] == 1 for lab in own)))
    out = []
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        shares, steps = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                before = set(order[:step])
                reach = [m for m in own if not m[1] & before]
                gone = [m for m in reach if letter in m[1]]
                shares[letter] += len(gone)
                redundant = sum(letter in m[1] and bool(m[1] & before) for m in own)
                steps.append((letter, part, "".join(order), step + 1, len(reach) - len(gone), len(gone), redundant, sum(m[1] == {letter} for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone)))
        out += [(*s[1:], shares[s[0]]) for s in steps]
    return sorted(out, key=str)


def documents():
    rng = random.Random(4)
    prose = lambda n, k: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    texts = [None, "", " \t", "A", "É é", "one # two", "x" * 5000, "x" * 5000 + "y", prose(300, 20), prose(300, 1000), prose(300, 1000) + " $", "ABC " * 300, prose(250, 10_000).upper()]
    rows = [(i, rng.choice(texts), rng.choice(["s1", "s2", None, ""]), "p", 1, "g") for i in range(150)]
    rows += [rows[3], rows[3], (None, texts[5], "s1", "p", 1, "g"), (None, texts[5], "s1", "p", 1, "g"), (7, "one # two", "s2", "p", 1, "g")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1]), "x") for i in range(100)] + [(5, 1, 1, "x"), (None, 1, 1, "x"), (5000, 1, 1, "x")]
    return rows, labels


@pytest.mark.parametrize("held, target", [(16 << 20, 32 << 20), (500, 2000)])
def test_audit_by_brute_force(spark, monkeypatch, held, target):
    monkeypatch.setattr(filter_audit, "HELD", held)
    monkeypatch.setattr(filter_audit.bounds, "__defaults__", (target, 10_000))
    rows, labels = documents()
    got = filter_audit.interactions(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert rows_of(got.select(*names)) == plain(rows, labels)


def test_nothing(spark):
    assert filter_audit.interactions(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_prefixes_grow_where_texts_are_alike(spark):
    rows = [(("same header " * 20 + f"{i % 50:03d}").encode(),) for i in range(500)] + [((f"{i:05d}" * 40).encode(),) for i in range(500)]
    starts = filter_audit.bounds(spark.createDataFrame(rows, "text binary"), target=10_000)
    assert max(map(len, starts)) > 200 and 20 <= len(starts) <= 60 and starts == sorted(starts)


def test_trie_keeps_every_text():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(2000)] + [b"a" * 100_000, b"a" * 100_000 + b"b"]
    trie, want = filter_audit.Trie(), {}
    for i, text in enumerate(texts):
        trie.spot(text)[0] = i
        want[text] = i
    assert dict(trie.items()) == want
