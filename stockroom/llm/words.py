"""Words of many texts at once, as hashes with places in the joined bytes."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa

from stockroom.llm.common import RollingHash, byte_view, mix64, per_worker

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def lowered(body: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[body]


def spaced() -> np.ndarray:
    """Which bytes are part of a word when words are separated by white space (0x20, 0x09-0x0D)."""
    inside = np.ones(256, bool)
    inside[[32, *range(9, 14)]] = False
    return inside


#: Code points of scripts that are written without spaces between words.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF),
    (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


def alphanumeric() -> np.ndarray:
    """Which code points are part of a word: 1 for letters, marks and digits of any script, 2 for letters and
    marks of scripts without spaces, which are a word each, 0 for others (blanks, punctuation, symbols)."""

    def build() -> np.ndarray:
        groups = [unicodedata.category(chr(c)) for c in range(0x110000)]
        inside = np.isin(np.array([g[0] for g in groups]), ["L", "M", "N"]) | np.isin(groups, ["Cn", "Co"])
        out = inside.astype(np.int8)
        digit = np.array(groups) == "Nd"
        for low, high in UNSPACED:
            out[low : high + 1][inside[low : high + 1] & ~digit[low : high + 1]] = 2
        return out

    return per_worker("llm word characters", build)


def byte_classes(body: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class in ``inside`` (by code point) of the character that each byte of UTF-8 text is part of, and
    where the characters of class 2 start and end."""
    out = inside[body]
    heads = np.flatnonzero(body >= 0xC0)
    lead = body[heads].astype(np.int32)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        point[more] = point[more] << 6 | body[np.minimum(heads[more] + k, len(body) - 1)] & 0x3F
    kind = inside[np.minimum(point, len(inside) - 1)]
    for k in range(4):
        more = size > k
        out[np.minimum(heads[more] + k, len(body) - 1)] = kind[more]
    alone = kind == 2
    return out, heads[alone], heads[alone] + size[alone]


class Words:
    """The words of the texts of a binary array: ``hash``, ``start`` and ``end`` (in the joined bytes) of
    each, and the n + 1 offsets ``at`` of the texts in the words. ``inside`` is ``spaced()`` (of bytes) or
    ``alphanumeric()`` (of code points)."""

    def __init__(self, texts: pa.Array, inside: np.ndarray):
        body, cuts = byte_view(texts)
        self.body, self.cuts = lowered(body), cuts
        word = np.zeros(len(body) + 1, np.int8)
        alone, ends = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(inside) == 256:
            word[:-1] = inside[body]
        else:
            kind, alone, ends = byte_classes(body, inside)
            word[:-1] = kind == 1
        edge = np.diff(word, prepend=np.int8(0))
        # a text's end ends its last word, even where the next text begins with one
        cut = cuts[(cuts > 0) & (cuts < len(body))]
        joined = np.unique(cut[(word[cut] == 1) & (word[cut - 1] == 1)])
        self.start = np.sort(np.concatenate([np.flatnonzero(edge == 1), joined, alone]))
        self.end = np.sort(np.concatenate([np.flatnonzero(edge == -1), joined, ends]))
        self.hash = RollingHash(self.body, _BASES[0]).of(self.start, self.end) if len(body) else np.empty(0, np.uint64)
        self.at = np.searchsorted(self.start, cuts)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the ``size`` words from each word on, and whether they are all in its text."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out[: max(0, n - k)] = mix64(out[: max(0, n - k)] * np.uint64(0x100000001B3) + self.hash[k:] + np.uint64(k + 1))
        last = np.repeat(self.at[1:], np.diff(self.at)) - size
        return out, np.arange(n) <= last
