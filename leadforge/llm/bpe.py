"""Byte-pair encoding by a dynamic programme over prefixes, and decoding.

The encoding of every prefix of a word has one last token. The tokens that end at a position come from an automaton over
the vocabulary; of these, exactly one may follow the last token of the prefix before it, which a test on the pair
decides. Following the last tokens back from the end of the word gives its ids, in time linear in its length.

Cases: a null or empty text has no ids and decodes to the empty text; whole texts are encoded, however long; columns of
other names are kept as they are, and a column of the input that has an output's name is replaced. Null ids decode to
the empty text; an id that the vocabulary lacks raises.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.llm.common import ship, tidy

WORDS_KEPT, WORD_LENGTH, BYTES_KEPT = 250_000, 64, 32 << 20  # of the cache: words, characters of one, bytes of all
PAIRS_KEPT = 400_000
ROWS = 256
END = "Ā"  # stands behind the last byte of a word; bytes are the characters below it
NEVER = 1 << 60


def byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 as is, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges as trees, the automaton of self-encoding tokens, and the test of pairs."""

    def __init__(self, description: str):
        spec = json.loads(description)
        model = spec["model"]
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = [p for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or kinds != ["NFC", "Replace", "Lowercase"] or len(split) != 1:
            raise ValueError("only byte-level BPE with word ends, NFC, white space and lower-case normalisation is supported")
        self.spec = description
        self.suffix = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        self.size = 1 + max([*self.ids.values(), *(a["id"] for a in spec["added_tokens"])])
        self.names = [""] * self.size
        for name, i in chain(self.ids.items(), ((a["content"], a["id"]) for a in spec["added_tokens"])):
            self.names[i] = name
        for added in spec["added_tokens"]:
            if added["single_word"] or added["lstrip"] or added["rstrip"] or added["normalized"]:
                raise ValueError("added tokens have to be matched as they stand")
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.word = regex.compile(split[0]["pattern"]["Regex"])
        self.automaton = None

    def prepare(self) -> None:
        """Builds what encoding needs; decoding does without."""
        if self.automaton is None:
            self._merges(json.loads(self.spec)["model"]["merges"])
            self._automaton()

    def _merges(self, merges: list) -> None:
        self.rank, self.parts, self.made = {}, {}, {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = self.ids[left], self.ids[right], self.ids[left + right]
            self.rank.setdefault(a * self.size + b, rank)
            if c not in self.made:
                self.made[c], self.parts[c] = rank, (a, b)
                if max(self.made.get(a, -1), self.made.get(b, -1)) >= rank:
                    raise ValueError("a merge uses a token that is made later")
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that touch one end while the token is built, each with the rank at which it is merged away."""
        kept = self._right if side else self._left
        if token not in kept:
            spine, gone, at = [], NEVER, token
            while True:
                spine.append((at, gone))
                if at not in self.parts:
                    break
                gone, at = self.made[at], self.parts[at][side]
            kept[token] = spine
        return kept[token]

    def first_crossing(self, a: int, b: int) -> int:
        """The rank of the first merge across the border of two tokens' bytes; NEVER if the tokens stay apart.

        A merge of x and y can fire while x ends the left side and y begins the right side. Of equal merges the left one
        goes first, so x may not be merged away at the same rank, but y may.
        """
        rank, size, first = self.rank, self.size, NEVER
        right = self._spine(b, 0)
        for x, x_gone in self._spine(a, 1):
            base = x * size
            for y, y_gone in right:
                at = rank.get(base + y)
                if at is not None and at < x_gone and at <= y_gone and at < first:
                    first = at
        return first

    def _automaton(self) -> None:
        table = byte_characters()
        sound: dict[int, bool] = {}

        def itself(token: int) -> bool:
            """Whether the token's bytes encode to the token."""
            todo = [token]
            while todo:
                at = todo[-1]
                if at in sound:
                    todo.pop()
                elif at not in self.parts:
                    sound[at] = True
                else:
                    a, b = self.parts[at]
                    if a in sound and b in sound:
                        sound[at] = sound[a] and sound[b] and self.first_crossing(a, b) == self.made[at]
                    else:
                        todo += [x for x in (a, b) if x not in sound]
            return sound[token]

        automaton = ahocorasick.Automaton()
        for name, token in self.ids.items():
            stem, end = (name[: -len(self.suffix)], END) if name.endswith(self.suffix) and len(name) > len(self.suffix) else (name, "")
            if stem and all(ch in table for ch in stem) and itself(token):
                automaton.add_word("".join(chr(table[ch]) for ch in stem) + end, (token, len(stem)))
        automaton.make_automaton()
        self.automaton = automaton

    def decode(self, ids) -> str:
        names = self.names
        return " ".join([names[i] for i in ids])


class Encoder:
    """Encodes texts; keeps the ids of words seen, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        vocabulary.prepare()
        self.vocabulary = vocabulary
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.assigned: dict[str, bool] = {}
        self._plain = None

    def piece(self, word: str) -> list[int]:
        """The ids of one word, given as one character for each of its bytes."""
        vocabulary, pairs, n = self.vocabulary, self.pairs, len(word)
        size = vocabulary.size
        last, lengths = [-1] * (n + 1), [0] * (n + 1)
        for end, (token, length) in vocabulary.automaton.iter(word + END):
            if end == n:  # a token with the word's end
                at, start = n, n - length
            else:
                at = end + 1
                if at == n:
                    continue
                start = at - length
            if last[at] >= 0:
                continue
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before * size + token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS_KEPT:
                        pairs.clear()
                    fits = pairs[key] = vocabulary.first_crossing(before, token) == NEVER
                if not fits:
                    continue
            last[at], lengths[at] = token, length
        ids, at = [], n
        while at:
            if last[at] < 0:
                raise ValueError("the vocabulary cannot spell this text")
            ids.append(last[at])
            at -= lengths[at]
        ids.reverse()
        return ids

    def _missing(self, word: str) -> bytes:
        """The ids of a word that is not kept. Only short words are, and of them so many bytes, whatever the texts hold."""
        raw = np.array(self.piece(word.encode("utf-8", "surrogatepass").decode("latin-1")), np.int32).tobytes()
        if len(word) <= WORD_LENGTH:
            size = 4 * len(word) + len(raw)
            if len(self.words) >= WORDS_KEPT or self.held + size > BYTES_KEPT:
                self.words.clear()
                self.held = 0
            self.words[word] = raw
            self.held += size
        return raw

    def _known(self, text: str) -> bool:
        """Whether every character had a meaning in this Python's Unicode, so that newer tables agree on it."""
        assigned = self.assigned
        for ch in set(text):
            known = assigned.get(ch)
            if known is None:
                known = assigned[ch] = unicodedata.category(ch) != "Cn"
            if not known:
                return False
        return True

    def _rare(self, text: str) -> list[bytes]:
        """Texts with characters newer than this Python's tables: the tokenizer file's own rules cut them into words."""
        if self._plain is None:
            from tokenizers import Tokenizer

            self._plain = Tokenizer.from_str(self.vocabulary.spec)
        table = byte_characters()
        pieces = self._plain.pre_tokenizer.pre_tokenize_str(self._plain.normalizer.normalize_str(text))
        return [np.array(self.piece("".join(chr(table[ch]) for ch in piece)), np.int32).tobytes() for piece, _ in pieces]

    def _span(self, text: str) -> list[bytes]:
        if not text.isascii():
            if not self._known(text):
                return self._rare(text)
            # Character by character, a capital sigma becomes the inner small one wherever it stands.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        words, out = self.words, []
        for word in self.vocabulary.word.findall(text.lower()):
            raw = words.get(word)
            out.append(self._missing(word) if raw is None else raw)
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.vocabulary.cut is None or not self.vocabulary.cut.search(text):
            return b"".join(self._span(text))
        parts = []
        for part in self.vocabulary.cut.split(text):
            special = self.vocabulary.added.get(part)
            parts += self._span(part) if special is None else [np.int32(special).tobytes()]
        return b"".join(parts)


_VOCABULARIES: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """One vocabulary per worker and broadcast description."""
    if shared.value[0] not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[shared.value[0]] = Vocabulary(shared.value[1])
    return _VOCABULARIES[shared.value[0]]


def _share(spark: SparkSession, path: str):
    """The tokenizer file, read once by the driver; its size is that of a vocabulary, not of the data."""
    ship(spark)
    with open(path, encoding="utf-8") as file:
        description = file.read()
    return spark.sparkContext.broadcast((hash(description), description))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with the ids of the whole text as an array of integers.

    ``decoded`` names a further column for the text that the ids stand for.
    """
    shared = _share(docs.sparkSession, path)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (ids, decoded)]
    fields = [docs.schema[c] for c in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))

    def run(batches):
        encoder = Encoder(_vocabulary(shared))
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                raws = [encoder.encode(x.as_py()) for x in batch.column(text)]
                offsets = np.zeros(len(raws) + 1, np.int32)
                np.cumsum([len(r) // 4 for r in raws], out=offsets[1:])
                flat = np.frombuffer(b"".join(raws), np.int32)
                columns = [*[batch.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                if decoded:
                    texts = [encoder.vocabulary.decode(np.frombuffer(r, np.int32).tolist()) for r in raws]
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.mapInArrow(tidy(run), T.StructType(fields))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for: tokens joined by a space, as a tokenizer without decoder does."""
    shared = _share(df.sparkSession, path)
    kept = df.drop(decoded)
    schema = T.StructType([*kept.schema.fields, T.StructField(decoded, T.StringType())])

    def run(batches):
        vocabulary = _vocabulary(shared)
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                texts = [vocabulary.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else ()) for x in batch.column(ids)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, decoded])

    return kept.mapInArrow(tidy(run), schema)


def ids_digest(ids: str | Column) -> Column:
    """Lower-case hex SHA-256 of the decimal ids joined by one space."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded text."""
    both = encode(docs.select("doc_id", "text"), path, decoded="decoded", keep=["doc_id"])
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
