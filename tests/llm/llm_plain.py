"""Plain versions of operators, for comparison on small tables."""

import hashlib

import xxhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, ids):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [least.get(root(i)) for i in range(len(ids))]


def repeated(rows):
    """Bytes to keep, by brute force: rows of (id, text)."""
    first = {}
    for doc, text in rows:
        for i in range(len(text) - 49):
            w = text[i : i + 50]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
