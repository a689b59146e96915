"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pytest

from llm_plain import rows_of
from leadforge.llm import repair

TALKS = "conv_id long, turn int, role string, text string, edit string, copies_ int"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, messages) by Dijkstra over (rows read, place in the grammar)."""
    heap, done = [(0, "", 0, 0, ())], set()  # places: 0 nothing yet, 1 after s, 2 after u, 3 after a
    while heap:
        cost, audit, at, place, made = heapq.heappop(heap)
        if at == len(rows) and place in (0, 3):
            return cost, audit, made
        if (at, place) in done:
            continue
        done.add((at, place))
        step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
        for role in ("user", "assistant"):
            if place in step[role[0]]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, step[role[0]][place], (*made, (role, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, place, made))
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                if place in step.get(role[:1], {}):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, step[role[0]][place], (*made, (role, text))))
                for other in ("user", "assistant"):
                    if place in step[other[0]]:
                        heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, step[other[0]][place], (*made, (other, text))))


def plain(rows):
    """One conversation's summary."""
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3])))
    seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        marked.append((role, text, fault))
        if fault:
            counts[fault] += 1
    turns = {t for _, t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, made = cheapest(marked)
    text = "\n".join(f"{r}:{t}" for r, t in made)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), made


def talks(seed=1, n=150):
    rng, rows = random.Random(seed), []
    text = lambda: rng.choice(["a.", "b!", "c", "d?\n", " ", "", None, "a.", "é.\x1f", "e. \t", f"{rng.random()}."])
    for conv in range(n):
        for turn in range(rng.randrange(9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "Usher"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text()))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rows += [(None, 1, "user", "x."), (None, 2, "assistant", "y."), (None, None, "system", "z.")]
    rows += [(900, t, "ua"[t % 2] + "x", "." * (t % 90 + 1)) for t in range(300)]  # longer than a chunk
    rows += [(901, rng.randrange(20), "user", "same.") for _ in range(400)]
    return rows


@pytest.mark.parametrize("chunk", [5, 512])
def test_repair_by_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = talks()
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], TALKS)
    want, texts = [], []
    broken = damaged(rows)
    for conv in {r[0] for r in rows}:
        summary, made = plain([r for r in broken if r[0] == conv])
        want.append((conv, *summary))
        texts += [(conv, i, r, t) for i, (r, t) in enumerate(made)]
    assert rows_of(repair.repaired(frame)) == sorted(want, key=str)
    assert rows_of(repair.messages(repair.damaged(frame)).drop("edit")) == sorted(texts, key=str)


def test_nothing_and_no_rows_left(spark):
    empty = spark.createDataFrame([], TALKS)
    assert repair.repaired(empty).count() == 0 and repair.messages(empty).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repaired(spark.createDataFrame([(gone, 0, "user", "a.", "", 0)], TALKS)).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_every_short_conversation(spark):
    """The walk over all sequences of up to four rows equals the search."""
    kinds = {"s": ("system", "t.", None), "u": ("user", "t.", None), "a": ("assistant", "t.", None), "U": ("user", "t", "truncated"), "o": ("tool", "t.", None), "x": ("user", "", "blank")}
    for n in range(5):
        for shape in product(kinds, repeat=n):
            tops = repair.walk(0, [(c, 1) for c in shape])
            best = min(tops[c] for c in repair.automaton().accepting if c in tops)
            assert best == cheapest([kinds[c] for c in shape])[:2], shape


def test_very_many_equal_rows(spark):
    rows = spark.range(30_000).selectExpr("cast(id % 3 as long) conv_id", "cast(null as int) turn", "'user' role", "'same.' text")
    got = {r.conv_id: r for r in repair.summaries(rows).collect()}
    assert got[0].duplicate == 9_999 and got[0].audit == "D" * 10_000 and got[0].cost == 20_000


def test_a_grammar_without_left_recursion_is_refused():
    with pytest.raises(ValueError):
        repair.Automaton((("talk", ()), ("talk", ("u", "a", "talk"))))
