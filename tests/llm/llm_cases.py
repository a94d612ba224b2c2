"""Rows that every operator must handle, and brute-force versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Names that operators use inside; inputs may have such columns too.
CLASHING = ["rid", "did", "body", "node", "digest", "kept", "keep", "label", "doc", "terms", "place", "count", "entropy", "value"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def frame(spark, rows, partitions=4):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)


LINE = "a line of more than forty characters, which several documents hold"
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog", "en"),
    (2, "THE QUICK brown fox jumps over the lazy dog", "en"),
    (2, "THE QUICK brown fox jumps over the lazy dog", "en"),
    (3, None, "en"),
    (4, "", None),
    (None, "a text without a number", "en"),
    (None, None, None),
    (5, " \n\t ", "de"),
    (6, "x" * 30_000, "de"),
    (7, "word " * 20_000, "en"),
    (8, "ÉÉ ünï中文 \U0001f600 naïve café em", "fr"),
    (9, "12345 !!! ...", "en"),
    (10, "one two", "en"),
    (11, "one", "en"),
    *[(20 + i, f"{i} first\n  {LINE.upper()}\t\nlast {i}", "en") for i in range(6)],
    (-5, LINE, "en"),
]


def normal(text):
    return (text or "").translate(AZ)


def shingle_set(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", normal(text))
    if len(words) >= n:
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def linked_components(texts, n, share):
    """doc_id -> smallest doc_id of its component, for distinct doc_ids."""
    sets = {d: shingle_set(t, n) for d, t in texts}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [d for d in sets if sets[d]]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= share * max(len(x), len(y)) and 100 * len(x & y) >= share * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: find(d) for d in sets}


def without_repeats(texts, length):
    """Per text (bytes): total, removed, spans and what is left when repeated strings go."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def without_frequent_lines(rows, min_chars=40, min_docs=5):
    """Per (doc_id, text): lines, dropped lines and the text that is left."""
    key = lambda line: normal(line.strip(" \t\n\x0b\x0c\r"))
    docs = set((-(1 << 63) if d is None else d, t or "") for d, t in rows)
    held = defaultdict(set)
    for d, t in docs:
        for line in t.split("\n"):
            held[key(line)].add((d, t))
    out = []
    for d, t in rows:
        me, lines = (-(1 << 63) if d is None else d, t or ""), (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or max(held[key(x)])[0] == me[0]]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out
