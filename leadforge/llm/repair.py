"""Conversation repair: the cheapest edits that make a conversation's roles a sentence of the role grammar.

The grammar (an optional system message, then pairs of user and assistant) is turned into an LR automaton. A row may be kept,
given another role, or deleted, and an empty message may be inserted anywhere; each action has its price. All choices are
followed at once: parse stacks share their lower cells and so form a graph, and where two ways lead to the same stack top the one
with the smaller (cost, audit) stays. The audit is the initials of the edits in order: Keep, Rerole, Delete, Insert. The grammar is
left recursive, so there are few stacks however long the conversation is.

Rows are parsed where a range partition by (conversation, turn, role, digest of the text) puts them, a bounded chunk at a time: a chunk
gives, for each stack it may begin with, the best way to each stack it may end with. Chunks of one conversation are then put together
in order, which is exact, as (cost, audit) pairs keep their order when a common way is put before or after them. So no conversation,
however long, is parsed by one task; only its chunk results and the text of its kept rows pass one task, as a stream (the digest of a
conversation is one chain). Equal rows of a conversation are counted before any shuffle of texts.

Cases: a null role or text is one space, which makes the row blank; a null conversation id is a conversation of its own; null
turns come first; rows of one turn are ordered by role and text digest; a role is known by its first character, any other than s, u and
a cannot be kept; equal rows are duplicates of the first one; a conversation without rows (all damaged away) has zeros, no
audit and the digest of nothing; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm.common import ship, stored, tidy

GRAMMAR = (("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")), ("pairs", ("u", "a")), ("pairs", ("pairs", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}  # what a row may be reroled to, or an inserted one have
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CHUNK = 512  # rows
WHITE = " \t\n\x0b\f\r"
END = "$"


class Automaton:
    """LR(0) states with one token of lookahead, and the stacks that can arise, as numbered cells (state, cell below)."""

    def __init__(self, rules=GRAMMAR):
        self.rules = (("", (rules[0][0],)), *rules)
        self.names = {left for left, _ in self.rules}
        self._lookahead()
        start = self._closed({(0, 0)})
        self.states, self.goto = [start], {}
        for at, items in enumerate(self.states):  # grows while it is read
            for symbol in sorted({self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}):
                target = self._closed({(r, dot + 1) for r, dot in items if self.rules[r][1][dot : dot + 1] == (symbol,)})
                if target not in self.states:
                    self.states.append(target)
                self.goto[at, symbol] = self.states.index(target)
        self.cells, self.number = [(0, None)], {(0, None): 0}
        tokens = sorted({x for _, right in self.rules for x in right} - self.names)
        self.after = {}
        for cell, _ in enumerate(self.cells):  # grows while it is read
            for token in tokens:
                self.after[cell, token] = self._shifted(cell, token)
            if len(self.cells) > 1000:
                raise ValueError("the grammar must be left recursive: its stacks grow without end")
        self.begins = sorted({0}.union(*self.after.values()))  # the stacks between two rows
        self.accepting = [c for c in range(len(self.cells)) if self._accepts(c)]

    def _closed(self, items):
        items, pending = set(items), list(items)
        while pending:
            rule, dot = pending.pop()
            wanted = self.rules[rule][1][dot : dot + 1]
            for other, (left, _) in enumerate(self.rules):
                if wanted == (left,) and (other, 0) not in items:
                    items.add((other, 0))
                    pending.append((other, 0))
        return frozenset(items)

    def _lookahead(self):
        """The tokens that may follow each name, as a fixed point."""
        empty, first, follow = set(), {n: set() for n in self.names}, {n: set() for n in self.names}
        follow[""].add(END)
        before = None
        while before != (before := (len(empty), *map(len, first.values()), *map(len, follow.values()))):
            for left, right in self.rules:
                if all(x in empty for x in right):
                    empty.add(left)
                for symbol in right:
                    first[left] |= first.get(symbol, {symbol})
                    if symbol not in empty:
                        break
                tail = set(follow[left])
                for symbol in reversed(right):
                    if symbol in self.names:
                        follow[symbol] |= tail
                    own = first.get(symbol, {symbol})
                    tail = tail | own if symbol in empty else set(own)
        self.follow = follow

    def _pushed(self, below, symbol):
        key = (self.goto[self.cells[below][0], symbol], below)
        if key not in self.number:
            self.number[key] = len(self.cells)
            self.cells.append(key)
        return self.number[key]

    def _reduced(self, cell, token):
        """The cell and all that reductions with this token ahead make of it."""
        found, pending = [cell], [cell]
        while pending:
            top = pending.pop()
            for rule, dot in sorted(self.states[self.cells[top][0]]):
                left, right = self.rules[rule]
                if rule and dot == len(right) and token in self.follow[left]:
                    below = top
                    for _ in right:
                        below = self.cells[below][1]
                    if (self.cells[below][0], left) in self.goto and (made := self._pushed(below, left)) not in found:
                        found.append(made)
                        pending.append(made)
        return found

    def _shifted(self, cell, token):
        return tuple(self._settled(self._pushed(c, token)) for c in self._reduced(cell, token) if (self.cells[c][0], token) in self.goto)

    def _settled(self, cell):
        """Where a state can do nothing but reduce, it does so at once, and more stacks are equal."""
        while True:
            items = self.states[self.cells[cell][0]]
            (rule, dot), *others = items
            left, right = self.rules[rule]
            if others or not rule or dot < len(right) or not right:
                return cell
            for _ in right:
                cell = self.cells[cell][1]
            if (self.cells[cell][0], left) not in self.goto:
                return cell
            cell = self._pushed(cell, left)

    def _accepts(self, cell):
        return any((0, 1) in self.states[self.cells[c][0]] for c in self._reduced(cell, END))


@lru_cache(1)
def automaton() -> Automaton:
    return Automaton()


def _offer(tops: dict, cell: int, way: tuple[int, str]) -> bool:
    """Equal stack tops merge: the smaller (cost, audit) stays."""
    if cell in tops and tops[cell] <= way:
        return False
    tops[cell] = way
    return True


def _with_insertions(tops: dict) -> dict:
    after, pending = automaton().after, list(tops)
    while pending:
        cell = pending.pop()
        cost, audit = tops[cell]
        for token in ROLES:
            pending += [c for c in after[cell, token] if _offer(tops, c, (cost + INSERT, audit + "I"))]
    return tops


def walk(start: int, runs: Iterable[tuple[str, int]]) -> dict[int, tuple[int, str]]:
    """From one stack over rows to every stack that can be reached, each by its cheapest way.

    A row is the initial of its role (``o`` for another one), in upper case if its text is truncated, or ``x`` if it must go; runs of
    rows that must go come with their number: inserting among them is never better than after them.
    """
    after = automaton().after
    tops = _with_insertions({start: (0, "")})
    for row, number in runs:
        if row == "x":
            tops = _with_insertions({c: (cost + DELETE * number, audit + "D" * number) for c, (cost, audit) in tops.items()})
            continue
        extra, initial = TRUNCATED * row.isupper(), row.lower()
        for _ in range(number):
            fresh: dict = {}
            for cell, (cost, audit) in tops.items():
                _offer(fresh, cell, (cost + DELETE, audit + "D"))
                for kept in after.get((cell, initial), ()):
                    _offer(fresh, kept, (cost + extra, audit + "K"))
                for token in ROLES:
                    for made in after[cell, token]:
                        _offer(fresh, made, (cost + REROLE + extra, audit + "R"))
            tops = _with_insertions(fresh)
    return tops


@lru_cache(20_000)
def _walk_short(start: int, shape: str) -> dict[int, tuple[int, str]]:
    return walk(start, [(c, 1) for c in shape])


def _ways(first: bool, runs: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) of a chunk; a conversation's first chunk has one stack to begin with."""
    short = "".join(row * number for row, number in runs) if sum(n for _, n in runs) <= 16 else None
    out = []
    for start in [0] if first else automaton().begins:
        tops = walk(start, runs) if short is None else _walk_short(start, short)
        out += [(start, end, cost, audit) for end, (cost, audit) in tops.items()]
    return out


def _joined(before: dict, ways: Iterable[tuple[int, int, int, str]]) -> dict:
    tops: dict = {}
    for start, end, cost, audit in ways:
        if start in before:
            _offer(tops, end, (before[start][0] + cost, before[start][1] + audit))
    return tops


def _ending(tops: dict) -> tuple[int, str]:
    return min(tops[c] for c in automaton().accepting if c in tops)


# Rows in Spark ------------------------------------------------------------------------------------------------------

COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
WIRE = pa.struct([
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()), *[(c, pa.int64()) for c in COUNTS],
    ("ways", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
STATE = (
    "struct<first_turn: long, last_turn: long, first_initial: string, last_initial: string, " + ", ".join(f"{c}: long" for c in COUNTS)
    + ", ways: array<struct<start: int, end: int, cost: long, audit: string>>>"
)
ORDER = ["conv", "turn", "role", "digest"]


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with known faults: rows lost, emptied, without full stops, twice, or with a wrong role.

    ``copies`` is how often a row is there. Which rows are hit is decided by the CRC-32 of ``conv_id:turn`` (nulls: one space).
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(hit == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(hit == 3, 2).otherwise(1).cast("long").alias("copies"), hit.alias("hit"))
    return rows.filter("hit <> 0").drop("hit")


def _prepared(rows: DataFrame) -> DataFrame:
    """Nulls as one space, the copies, the id as text, and the digest that orders and compares texts."""
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    filled = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    named = rows.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), *filled, copies.alias("copies"))
    return named.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _narrow(prepared: DataFrame) -> DataFrame:
    """Distinct rows without their texts: how often they are there, if they are blank or truncated, and if an earlier turn has them."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    whole = F.substring(bare, -1, 1).isin(".", "!", "?")
    flagged = prepared.select(*ORDER, "copies", (bare == "").alias("is_blank"), (~whole).alias("is_cut"))
    rows = stored(flagged.groupBy(*ORDER, "is_blank", "is_cut").agg(F.sum("copies").alias("copies")), "turns")
    # A struct of (turn is there, turn) has the order of turns with nulls first.
    turn = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn").alias("at"))
    same = ["conv", "role", "digest"]
    firsts = rows.groupBy(*same).agg(F.min(turn).alias("seen")).select(*[F.col(c).alias(f"{c}_r") for c in same], "seen")
    joined = rows.join(firsts, [F.col(c).eqNullSafe(F.col(f"{c}_r")) for c in same])
    return joined.select(*ORDER, "copies", "is_blank", "is_cut", (~turn.eqNullSafe(F.col("seen"))).alias("is_repeat"))


def _chunks(narrow: DataFrame) -> DataFrame:
    """Rows (conv, part, chunk, state): range partitions of the ordered rows, parsed chunk by chunk."""
    wire = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("state", WIRE)])

    def run(batches):
        part = TaskContext.get().partitionId()  # partitions are ranges, numbered in order
        for some in _batched(_parsed(part, _rows(batches)), 500):
            yield pa.RecordBatch.from_pylist(some, schema=wire)

    return narrow.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(tidy(run), f"conv string, part int, chunk int, state {STATE}")


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _batched(items: Iterable, size: int) -> Iterator[list]:
    held = []
    for item in items:
        held.append(item)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def _illegal(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


class _Chunk:
    def __init__(self, conv, number: int, first: bool):
        self.conv, self.number, self.first, self.runs, self.rows = conv, number, first, [], 0
        self.state = {"first_turn": None, "last_turn": None, "first_initial": None, "last_initial": None, **dict.fromkeys(COUNTS, 0)}

    def add(self, turn, initial, copies, is_blank, is_cut, is_repeat):
        state, last = self.state, self.state["last_initial"]
        if last is None:
            state["first_initial"] = initial
        elif _illegal(last + initial):
            state["illegal"] += 1
        state["illegal"] += (copies - 1) * _illegal(initial + initial)
        state["last_initial"] = initial
        if turn is not None and turn != state["last_turn"]:
            state["turns"] += 1
            state["first_turn"] = turn if state["first_turn"] is None else state["first_turn"]
            state["last_turn"] = turn
        if is_blank or is_repeat:
            state["blank" if is_blank else "duplicate"] += copies
            self.runs.append(("x", copies))
        else:
            state["duplicate"] += copies - 1
            state["truncated"] += is_cut
            known = initial if initial and initial in "sua" else "o"
            self.runs.append((known.upper() if is_cut else known, 1))
            if copies > 1:
                self.runs.append(("x", copies - 1))
        self.rows += 1

    def row(self, part: int) -> dict:
        ways = [dict(zip(("start", "end", "cost", "audit"), way)) for way in _ways(self.first, self.runs)]
        return {"conv": self.conv, "part": part, "chunk": self.number, "state": {**self.state, "ways": ways}}


def _parsed(part: int, rows: Iterable[tuple]) -> Iterator[dict]:
    chunk = None
    for conv, turn, role, _, copies, is_blank, is_cut, is_repeat in rows:
        if chunk is None:
            chunk = _Chunk(conv, 0, False)  # what a partition begins with may have begun in an earlier one
        elif conv != chunk.conv:
            yield chunk.row(part)
            chunk = _Chunk(conv, 0, True)
        elif chunk.rows >= CHUNK:
            yield chunk.row(part)
            chunk = _Chunk(conv, chunk.number + 1, False)
        chunk.add(turn, role[:1], copies, is_blank, is_cut, is_repeat)
    if chunk is not None:
        yield chunk.row(part)


class _Conversation:
    """One conversation as it streams by: its chunks in order, then the texts of its rows in the same order."""

    def __init__(self, conv):
        self.conv, self.tops, self.chosen = conv, {0: (0, "")}, None
        self.counts = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.initial = None
        self.at, self.position, self.expected, self.digest = 0, 0, "u", hashlib.sha256()

    def chunk(self, state: dict):
        for name in COUNTS:
            self.counts[name] += state[name]
        if self.initial is not None:
            self.counts["illegal"] += _illegal(self.initial + state["first_initial"])
        self.initial = state["last_initial"]
        if state["first_turn"] is not None:
            self.counts["turns"] -= state["first_turn"] == self.high
            self.low, self.high = state["first_turn"] if self.low is None else self.low, state["last_turn"]
        self.tops = _joined(self.tops, [(w["start"], w["end"], w["cost"], w["audit"]) for w in state["ways"]])

    def choice(self) -> tuple[int, str]:
        if self.chosen is None:
            self.chosen = min(self.tops[c] for c in automaton().accepting if c in self.tops)
        return self.chosen

    def _message(self, role: str, text: str, edit: str) -> dict:
        self.digest.update(("\n" if self.position else "").encode() + f"{role}:{text}".encode())
        self.expected = "a" if role[:1] == "u" else "u"
        self.position += 1
        return {"conv": self.conv, "position": self.position - 1, "role": role, "text": text, "edit": edit}

    def insertions(self) -> Iterator[dict]:
        audit = self.choice()[1]
        while audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._message(ROLES[self.expected], "", "I")

    def row(self, role: str, text: str, copies: int) -> Iterator[dict]:
        """The messages that the edits up to and with this row give."""
        audit = self.choice()[1]
        while copies:
            yield from self.insertions()
            edit, gone = audit[self.at], 1
            if edit != "D":
                yield self._message(role if edit == "K" else ROLES[self.expected], text, edit)
            elif audit.startswith("D" * copies, self.at):
                gone = copies
            self.at, copies = self.at + gone, copies - gone

    def summary(self) -> dict:
        cost, audit = self.choice()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts["turns"]
        return {"conv": self.conv, "gaps": gaps, **{c: self.counts[c] for c in COUNTS[:4]}, "cost": cost, "audit": audit, "repaired_sha256": self.digest.hexdigest()}


def _conversations(rows: Iterable[tuple]) -> Iterator[tuple[_Conversation, Iterator[dict]]]:
    """Each conversation with messages as they come; after the last one its state is whole."""
    current, nothing = None, ()
    for conv, kind, _, _, state, _, role, _, copies, text in rows:
        if current is None or conv != current.conv:
            if current is not None:
                yield current, current.insertions()
            current = _Conversation(conv)
        if kind == 1:
            current.chunk(state)
        elif kind == 2:
            yield current, current.row(role, text, copies)
        else:
            yield current, nothing
    if current is not None:
        yield current, current.insertions()


def _stream(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation its id, its chunks, then its distinct rows with text, in order within one partition."""
    prepared = _prepared(rows)
    chunks = _chunks(_narrow(prepared)).withColumn("kind", F.lit(1))
    texts = prepared.groupBy(*ORDER, "text").agg(F.sum("copies").alias("copies")).withColumn("kind", F.lit(2))
    parts = chunks.unionByName(texts, allowMissingColumns=True)
    if ids is not None:
        named = ids.select(F.col("conv_id").cast("string").alias("conv")).distinct().withColumn("kind", F.lit(0))
        parts = parts.unionByName(named, allowMissingColumns=True)
    order = ["conv", "kind", "part", "chunk", "turn", "role", "digest"]
    whole = parts.select("conv", "kind", "part", "chunk", "state", "turn", "role", "digest", "copies", "text")
    return whole.repartition("conv").sortWithinPartitions(*order)


def _run(rows: DataFrame, ids: DataFrame | None, each, schema: str) -> DataFrame:
    ship(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    fields = T.StructType.fromDDL(f"conv string, {schema}")
    wire = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64()}[f.dataType.simpleString()]) for f in fields])

    def run(batches):
        for some in _batched(each(_conversations(_rows(batches))), 500):
            yield pa.RecordBatch.from_pylist(some, schema=wire)

    out = _stream(rows, ids).mapInArrow(tidy(run), fields)
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *fields.names[1:])


def messages(rows: DataFrame) -> DataFrame:
    """The repaired conversations: a row (conv_id, position, role, text, edit) for each message kept, reroled or inserted.

    ``rows`` has conv_id, turn, role and text, and may have ``copies``, how often the row is there.
    """

    def each(conversations):
        for _, made in conversations:
            yield from made

    return _run(rows, None, each, "position long, role string, text string, edit string")


def summaries(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults, the cost and audit of its repair, and the digest of its repaired messages.

    ``ids`` names (``conv_id``) conversations to be listed even if they have no row.
    """

    def each(conversations):
        last = None
        for conversation, made in conversations:
            if last is not None and conversation is not last:
                yield last.summary()
            last = conversation
            for _ in made:
                pass
        if last is not None:
            yield last.summary()

    return _run(rows, ids, each, SUMMARY)


def repaired(conversations: DataFrame) -> DataFrame:
    """The summaries of damaged conversations, every original one listed."""
    return summaries(damaged(conversations), conversations.select("conv_id"))
