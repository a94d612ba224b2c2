"""Splitting texts into the pieces that byte-level BPE encodes one by one.

``piece_ends`` finds, over the joined bytes of many texts, the pieces that the split pattern of the
public byte-level vocabularies makes. It works on byte classes with numpy and covers texts whose
characters are ASCII or Latin letters of U+00C0..U+024F; ``plain`` tells which texts these are. Other
texts are split by the pattern itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stockroom.llm.common import byte_view, per_worker

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: What follows an apostrophe in the pieces of the pattern that start with one.
SHORT, LONG = b"stmd", (b"re", b"ve", b"ll")


def _classes() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    kinds[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
    kinds[48:58] = NUMBER
    kinds[[*range(9, 14), 32]] = SPACE
    return kinds


def plain(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text: whether its characters are ASCII or letters of U+00C0..U+024F."""
    odd = np.zeros(len(body) + 1, bool)
    odd[:-1] = ((body >= 0xC0) & ((body < 0xC3) | (body > 0xC9)))
    cross = (body[1:] == 0x97) | (body[1:] == 0xB7)
    odd[1:-1] |= (body[:-1] == 0xC3) & cross
    # lead byte C9 reaches U+027F
    odd[1:-1] |= (body[:-1] == 0xC9) & (body[1:] > 0x8F)
    sums = np.concatenate([[0], np.cumsum(odd)])
    return sums[at[1:]] == sums[at[:-1]]


def piece_ends(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Start offsets of the pieces of plain texts, with the end of the last one."""
    n = len(body)
    if not n:
        return np.zeros(1, np.int64)
    kind = _classes()[body]
    first = np.zeros(n + 1, bool)
    first[at[at < n]] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # a run that follows white space in its text takes a blank before it along
    runs = np.flatnonzero(start[1:] & ~first[1:n] & space[:-1] & ~space[1:]) + 1
    blank = body[runs - 1] == 32
    start[runs[blank]] = False
    start[runs - 1] = True
    # contractions: a lone apostrophe that begins a piece
    quotes = np.flatnonzero((body == 39) & start)
    quotes = quotes[quotes + 1 < n]
    quotes = quotes[~first[quotes + 1]]
    after = body[quotes + 1]
    short = np.isin(after, np.frombuffer(SHORT, np.uint8))
    two = quotes[(quotes + 2 < n)]
    two = two[~first[two + 2]]
    pair = np.zeros(len(two), bool)
    for a, b in LONG:
        pair |= (body[two + 1] == a) & (body[two + 2] == b)
    for q, size in ((quotes[short], 2), (two[pair], 3)):
        start[q + 1] = False
        follow = q + size
        start[follow[follow < n]] = True
        gone = follow[(follow < n)]
        # what follows a contraction begins a piece, unless it is a run that took a blank along
        keep = ~(first[gone]) & ~space[gone] & space[gone - 1]
        start[gone[keep]] = False
    return np.append(np.flatnonzero(start), n)


def _pattern():
    import public_tokenizers
    import regex

    white = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    spelled = public_tokenizers.PATTERN.replace(r"[^\s", "[^" + white).replace(r"(?!\S)", f"(?=[{white}]|\\Z)")
    return regex.compile(spelled.replace(r"\s", f"[{white}]"))


def split(text: str) -> list[str]:
    """The pieces of one text by the pattern, white space being Unicode's White_Space."""
    return per_worker("llm split pattern", _pattern).findall(text)


def pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pieces of the texts of a binary array, in order, and the n + 1 offsets of the texts in them."""
    body, at = byte_view(column)
    ok = plain(body, at)
    if ok.all():
        ends = piece_ends(body, at)
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))]
        return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers), np.searchsorted(ends, at)
    parts, counts = [], []
    edges = np.flatnonzero(np.diff(ok.astype(np.int8))) + 1
    for rows in np.split(np.arange(len(ok)), edges):
        part = column.slice(int(rows[0]), len(rows))
        if ok[rows[0]]:
            found, offsets = pieces(part)
            counts.append(np.diff(offsets))
        else:
            lists = [split(t.decode()) for t in part.to_pylist()]
            found = pa.array([p.encode() for one in lists for p in one], pa.large_binary())
            counts.append(np.array([len(one) for one in lists], np.int64))
        parts.append(found)
    return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def distinct_pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pieces of the texts, the number of each piece in order, and the texts' offsets."""
    found, offsets = pieces(column)
    coded = found.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), offsets
