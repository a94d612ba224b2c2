"""Operator 12: maximal periodic runs of words, found by string synchronising sets, and texts without the repeats.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are identical) and at least
``max(6, 4 * q)`` words that no neighbouring word extends. ``collapse`` lists all runs of every text and gives
the text without the words that only repeat: those that some run holds after its first ``q`` words.

Periods below ``DIRECT`` words are read off directly: the stretches of words equal to the word ``p`` places on
are the highly periodic regions. A longer period ``p`` is proposed at the scale ``t = 2**k`` with ``t <= p < 2 * t``:

1. Every window of ``t`` words has a hash of its content. Windows of period ``t / 4`` or less are omitted; they
   lie in regions that smaller scales have supplied.
2. Position ``i`` is in the synchronising set if the least hash of the windows at ``i .. i + t`` is at ``i`` or
   at ``i + t``. That depends on the ``2 * t`` words from ``i`` on alone, so equal contexts are chosen alike.
3. Nearest positions of equal context (``2 * t`` words) in one text propose their distance as a period.
4. Hashes of stretches extend the proposal to both sides; the words themselves then confirm each region or
   cut it where they differ.

A run of period ``p`` has ``4 * p >= 3 * t + p`` words, so one of its first ``t`` positions is chosen (were all
of its windows there omitted, ``p`` would not be its smallest period), and so is the one ``p`` words later: their
contexts are equal, and as a context is longer than ``p``, no nearer one is. Every run is thus proposed with its smallest
period. Different contexts of the same 64-bit hash could only hide a proposal, not make a false run.

Texts are handled many at a time in each task, joined by marks that equal no word; a scale works on texts of
at least ``4 * t`` words alone, so the work is about the words times the logarithm of their number. Nothing is
shuffled.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, compared byte for byte; a null or empty text, or one without
words, has no runs and an empty collapsed text; rows with the same doc_id are separate texts; a null doc_id is
kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stockroom.llm.common import RollingHash, byte_view, in_tasks, mix64, slices, text_array
from stockroom.llm.words import spaced

#: Periods below this are found by comparing words directly; a power of two.
DIRECT = 8
#: Least number of periods, and of words, in a run.
EXPONENT, LEAST = 4, 6

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def collapse(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, runs, collapsed) of every row; ``runs`` are ordered by start, then period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield _collapsed(part.column(key), part.column(text), key)

    kind = docs.schema[key].dataType.simpleString()
    return in_tasks(docs.select(key, text), run, f"`{key}` {kind}, n_words bigint, runs {RUNS}, collapsed string")


def _collapsed(keys: pa.Array, texts: pa.Array, key: str) -> pa.RecordBatch:
    words, at = words_of(text_array(texts))
    start, length, period = find_runs(words.dictionary_encode().indices.to_numpy(), at)
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    first = np.searchsorted(start, at)
    base = at[np.searchsorted(at, start, side="right") - 1]
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - base, length, period)], fields=list(_RUN))
    lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), rows)
    left = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, at).astype(np.int64)), words.take(pa.array(kept)))
    collapsed = pc.binary_join(left, pa.scalar(b" ", pa.large_binary())).cast(pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at), pa.int64()), lists, collapsed], [key, "n_words", "runs", "collapsed"])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts of a binary array, in order, and the n + 1 offsets of the texts in them."""
    body, cuts = byte_view(texts)
    inside = spaced()[body]
    word = np.zeros(len(body) + 1, np.int8)
    word[:-1] = inside
    edge = np.diff(word, prepend=np.int8(0))
    # a text's end ends its last word, even where the next text begins with one
    cut = cuts[(cuts > 0) & (cuts < len(body))]
    joined = np.unique(cut[(word[cut] == 1) & (word[cut - 1] == 1)])
    start = np.sort(np.concatenate([np.flatnonzero(edge == 1), joined]))
    end = np.sort(np.concatenate([np.flatnonzero(edge == -1), joined]))
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body[inside]))]
    return pa.Array.from_buffers(pa.large_binary(), len(start), buffers), np.searchsorted(start, cuts)


def find_runs(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, starts counted over the joined texts; ``at`` are the texts' offsets."""
    sizes = np.diff(at)
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    seq = np.insert(ids.astype(np.int64), at[1:], -1 - np.arange(len(sizes)))  # a mark behind each text
    left, right, period = _direct(seq)
    place = np.arange(len(seq))
    window = mix64(seq.astype(np.uint64))
    size, rolling = 1, None
    while size < DIRECT:
        window, size = _doubled(window, size), 2 * size
    while True:
        wanted = sizes >= EXPONENT * size
        if not wanted.any():
            break
        chosen = wanted[doc[place]]
        place, window = place[chosen], window[chosen]
        omitted = _omitted(left, right, period, size, len(seq))
        where = _synchronising(window, size, omitted[place] if omitted is not None else None)
        context = _doubled(window, size)
        i, j = _proposals(place[where], context[where], doc, at, size)
        if len(i):
            if rolling is None:
                rolling = RollingHash(mix64(seq.astype(np.uint64)))
            found = _confirmed(seq, *_extended(rolling, i, j, doc, at), EXPONENT)
            left, right, period = (np.concatenate(x) for x in zip((left, right, period), found, strict=True))
        window, size = context, 2 * size
    left, right, period = _distinct(left, right, period)
    long = right - left >= np.maximum(LEAST, EXPONENT * period)
    left, right, period = left[long], right[long], period[long]
    return left - doc[left], right - left, period


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of at least ``least`` true values."""
    edge = np.diff(equal.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return start[long], end[long]


def _direct(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the regions of at least ``EXPONENT`` periods below ``DIRECT``."""
    out = [(np.empty(0, np.int64),) * 3]
    for p in range(1, DIRECT):
        start, end = _stretches(seq[:-p] == seq[p:], (EXPONENT - 1) * p) if len(seq) > p else out[0][:2]
        out.append((start, end + p, np.full(len(start), p, np.int64)))
    return _distinct(*(np.concatenate(x) for x in zip(*out, strict=True)))


def _distinct(left: np.ndarray, right: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One of equal regions, with the least period."""
    order = np.lexsort((period, right, left))
    left, right, period = left[order], right[order], period[order]
    first = np.ones(len(left), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return left[first], right[first], period[first]


def _doubled(window: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of ``2 * size`` from those of ``size``; a window past the end equals no other."""
    after = np.arange(len(window), dtype=np.uint64)
    after[: max(0, len(window) - size)] = window[size:]
    return mix64(window * np.uint64(0x9E3779B97F4A7C15) + (after ^ (after >> np.uint64(29))) + np.uint64(size))


def _omitted(left: np.ndarray, right: np.ndarray, period: np.ndarray, size: int, n: int) -> np.ndarray | None:
    """Where windows of ``size`` lie in a region of period ``size / EXPONENT`` or less."""
    some = (period * EXPONENT <= size) & (right - left >= size)
    if not some.any():
        return None
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, left[some], 1)
    np.add.at(depth, right[some] - size + 1, -1)
    return np.cumsum(depth[:-1]) > 0


def _synchronising(window: np.ndarray, size: int, omitted: np.ndarray | None) -> np.ndarray:
    """The positions whose least window hash of the ``size + 1`` from there on is the first or the last."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    value = window if omitted is None else np.where(omitted, top, window)
    if len(value) <= size:
        return np.empty(0, np.int64)
    least, width = value, 1
    while width < size:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:-1], value[size:])
    n = len(least)
    return np.flatnonzero((least < top) & ((value[:n] == least) | (value[size:] == least)))


def _proposals(place: np.ndarray, context: np.ndarray, doc: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pairs of equal context in one text, at a distance from ``size`` to below ``2 * size``."""
    text = doc[place]
    whole = place + 2 * size <= at[text + 1] + text
    place, context, text = place[whole], context[whole], text[whole]
    own = mix64(context ^ mix64(text.astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    own, place, text = own[order], place[order], text[order]
    gap = place[1:] - place[:-1]
    near = (own[1:] == own[:-1]) & (text[1:] == text[:-1]) & (gap >= size) & (gap < 2 * size)
    return place[:-1][near], place[1:][near]


def _extended(rolling: RollingHash, i: np.ndarray, j: np.ndarray, doc: np.ndarray, at: np.ndarray):
    """(start, end, period) of the stretch around each pair in which words ``j - i`` apart have equal hashes."""
    text = doc[i]
    before = _longest(i - at[text] - text, lambda n: rolling.of(i - n, i) == rolling.of(j - n, j))
    behind = _longest(at[text + 1] + text - j, lambda n: rolling.of(i, i + n) == rolling.of(j, j + n))
    return i - before, j + behind, j - i


def _longest(most: np.ndarray, equal) -> np.ndarray:
    """The largest number up to ``most`` for which ``equal`` holds, by halving."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        holds = equal(middle)
        low, high = np.where(holds, middle, low), np.where(holds, high, middle - 1)
    return low


def _confirmed(seq: np.ndarray, left: np.ndarray, right: np.ndarray, period: np.ndarray, exponent: int):
    """The regions of at least ``exponent`` periods, as the words themselves say."""
    long = right - left >= exponent * period
    left, right, period = _distinct(left[long], right[long], period[long])
    sizes = right - left - period
    ends = np.cumsum(sizes + 1)  # one place between regions, where nothing is equal
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - 1 - left, sizes + 1)
    equal = seq[place] == seq[np.minimum(place + np.repeat(period, sizes + 1), len(seq) - 1)]
    equal[ends - 1] = False
    start, end = _stretches(equal, 1)
    region = np.searchsorted(ends, start, side="right")
    start, end = place[start], place[end]
    keep = end - start >= (exponent - 1) * period[region]
    return start[keep], end[keep] + period[region[keep]], period[region[keep]]
