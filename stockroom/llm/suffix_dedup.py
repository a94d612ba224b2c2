"""Operator 3: removal of every byte of a string of ``length`` bytes that occurs more than once.

Only suffixes that begin at *anchors* are sorted. The anchors of a document are the places of the least
``GRAM``-byte gram of each window of ``length`` bytes (rightmost on ties), so the choice depends on the
window's content alone: two equal windows hold an anchor at the same offset, in front of equal grams.
Anchors whose gram occurs once in the corpus are dropped by an aggregation over gram hashes. The *context*
of an anchor is the bytes of all windows around its gram; where a context occurs twice all its windows are
repeated, and one copy of it is enough in what follows.

The distinct contexts of the other grams are sorted as suffixes: sampled splitters range-partition them by
the leading bytes of the gram (equal grams stay together), and each bucket sorts the bytes behind the gram
and, reversed, those before it by multikey quicksort. With the common prefix lengths of neighbours in both
orders, a window that begins ``d`` bytes before the gram is repeated if and only if two contexts agree in
``d`` bytes to the left and the remaining ones to the right; this is read off for every ``d``. A gram with more than ``HOT``
distinct contexts does not fit one bucket: its windows are compared by 128-bit hashes in an aggregation,
which takes the place of comparing such buckets across their boundaries.

Bounds: gram hashes only choose candidates; contexts are told apart by 128-bit hashes, windows by their
bytes (by 128-bit hashes for hot grams). A document's spans are collected in one row, as its text is.

Defined results: a null text counts as empty; matches stay within a document and may overlap; rows with
the same doc_id and text are two documents, whose windows are all repeated; documents shorter than
``length`` stay whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import RollingHash, byte_view, in_tasks, mix64, save, slices, text_array

LENGTH, GRAM, HOT, RUN_BYTES, NO_ID = 400, 200, 50_000, 1 << 20, -(1 << 63)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
PLACE_BITS = np.uint64(31)
PLACES = np.uint64((1 << 31) - 1)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, did, body, text): a row with its key, doc_id (null smallest) and a hash of the text."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("body"), text.alias("text"))


def spread(body: np.ndarray) -> np.ndarray:
    """Bytes as scattered 64-bit values, for hashing."""
    return mix64(np.arange(1, 257, dtype=np.uint64))[body]


def anchor_places(body: np.ndarray, cuts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors' places in the joined bytes of texts with offsets ``cuts``, and the hashes of their grams."""
    n, width = len(body), length - gram + 1
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    if n < length:
        return none
    starts = np.arange(n - gram + 1)
    value = RollingHash(spread(body), BASES[0]).of(starts, starts + gram)
    end = np.repeat(cuts[1:], np.diff(cuts))
    inside = starts + gram <= end[: len(starts)]
    least = np.where(inside, (value >> PLACE_BITS << PLACE_BITS) | (PLACES - starts.astype(np.uint64)), np.uint64(0xFFFFFFFFFFFFFFFF))
    have = 1
    while 2 * have <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    if width > have:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    windows = np.arange(n - length + 1)
    least = least[: len(windows)][windows + length <= end[: len(windows)]]
    if not len(least):
        return none
    place = (PLACES - (least & PLACES)).astype(np.int64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])]
    return place, value[place]


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(did, body, pos, gram, c1, c2): every anchor with its gram's and its context's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                body, cuts = byte_view(text_array(part.column("text")))
                place, value = anchor_places(body, cuts, length, gram)
                doc = np.searchsorted(cuts, place, side="right") - 1
                low, high = np.maximum(place - (length - gram), cuts[doc]), np.minimum(place + length, cuts[doc + 1])
                apart = mix64((place - low).astype(np.uint64) * np.uint64(1 << 20) + (high - place).astype(np.uint64))
                c1, c2 = (RollingHash(spread(body), b).of(low, high) ^ apart for b in BASES[1:])
                where = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column("did").take(where), part.column("body").take(where), pa.array(place - cuts[doc]), *(pa.array(x.view(np.int64)) for x in (value, c1, c2))],
                    names=["did", "body", "pos", "gram", "c1", "c2"],
                )

    return in_tasks(docs.select("did", "body", "text"), run, "did long, body long, pos long, gram long, c1 long, c2 long")


def contexts(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(cid, gram, left, right) of the anchors of ``wanted`` (cid, gram, did, body, pos), from the texts;
    left is the bytes before the gram, reversed, right the gram and what follows."""
    places = wanted.groupBy("did", "body").agg(F.collect_list(F.struct("cid", "gram", "pos")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, some in zip(batch.column("text"), batch.column("places").to_pylist()):
                text = text.as_buffer().to_pybytes()
                rows = [(p["cid"], p["gram"], text[max(0, p["pos"] - (length - gram)) : p["pos"]][::-1], text[p["pos"] : p["pos"] + length]) for p in some]
                cid, name, left, right = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(name, pa.int64()), pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["cid", "gram", "left", "right"])

    # rows with the same doc_id and text give a context more than once; readers tell by cid
    return in_tasks(docs.select("did", "body", "text").join(places, ["did", "body"]).select("text", "places"), run, "cid long, gram long, left binary, right binary")


# --- within a bucket -----------------------------------------------------------------------------


def padded(strings: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """n x size symbols, a byte plus one each and zeros behind the end; and the lengths."""
    lens = np.fromiter(map(len, strings), np.int64, len(strings))
    out = np.zeros((len(strings), -(-size // 4) * 4), ">u2")
    flat = np.frombuffer(b"".join(strings), np.uint8).astype(">u2") + 1
    row = np.repeat(np.arange(len(strings)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out, lens


def multikey_quicksort(words: np.ndarray, few: int = 48) -> np.ndarray:
    """The order of the rows of ``words`` (n x m): three-way partitions by one word after another."""
    out = np.arange(len(words))
    raw, wide = words.astype(">u8").tobytes(), 8 * words.shape[1]
    todo = [(0, len(words), 0)]
    while todo:
        low, high, depth = todo.pop()
        while high - low > 1 and depth < words.shape[1]:
            rows = out[low:high]
            if high - low <= few:
                out[low:high] = sorted(rows.tolist(), key=lambda r: raw[r * wide : (r + 1) * wide])
                break
            key = words[rows, depth]
            pivot = np.partition(key, len(key) // 2)[len(key) // 2]
            less, more = key < pivot, key > pivot
            a, b = int(less.sum()), int(more.sum())
            out[low:high] = np.concatenate([rows[less], rows[~less & ~more], rows[more]])
            todo += [(low, low + a, depth), (high - b, high, depth)]
            low, high, depth = low + a, high - b, depth + 1
    return out


def sorted_with_lcp(group: np.ndarray, strings: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings by (group, string), and for each place in it the length of the common
    prefix with the string before (-1 at a group's first)."""
    symbols, lens = padded(strings, size)
    words = np.column_stack([group.astype(">u8").reshape(-1, 1), symbols.view(">u8")])
    order = multikey_quicksort(words)
    lcp = np.full(len(order), -1, np.int64)
    for start in range(1, len(order), 8192):
        a, b = order[start - 1 : start + 8191], order[start : start + 8192]
        a = a[: len(b)]
        differ = np.column_stack([symbols[a, :size] != symbols[b, :size], np.ones(len(b), bool)])
        same = np.minimum(differ.argmax(axis=1), np.minimum(lens[a], lens[b]))
        lcp[start : start + len(b)] = np.where(group[a] == group[b], same, -1)
    return order, lcp


def repeated_offsets(group: np.ndarray, left: list[bytes], right: list[bytes], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context the least and the greatest d such that the window that begins d bytes before its
    gram is also one of another context of its group; (reach + 1, -1) if there is none. ``right`` holds
    what follows the gram; window and gram differ by ``reach`` bytes."""
    n = len(group)
    low, high = np.full(n, reach + 1, np.int64), np.full(n, -1, np.int64)
    (by_left, lcp_left), (by_right, lcp_right) = (sorted_with_lcp(group, [s[:reach] for s in x], reach) for x in (left, right))
    class_left, class_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(reach + 1):
        class_left[by_left] = np.cumsum(lcp_left < d)
        class_right[by_right] = np.cumsum(lcp_right < reach - d)
        # contexts too short for the window are alone in their class
        both = class_left * (n + 1) + class_right
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        hit = np.zeros(n, bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        low[hit & (low > d)] = d
        high[hit] = d
    return low, high


def bucketed(found: DataFrame, length: int, gram: int) -> DataFrame:
    """(cid, low, high) of the contexts whose gram has others: range-partitioned by the gram's leading bytes."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        cid, name, left, right = zip(*{row[0]: row for row in rows}.values())
        low, high = repeated_offsets(np.array(name, np.int64).view(np.uint64), list(left), [r[gram:] for r in right], length - gram)
        hit = high >= 0
        return pa.RecordBatch.from_arrays([pa.array(np.array(cid)[hit]), pa.array(low[hit]), pa.array(high[hit])], ["cid", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("cid", "gram", "left", "right")))
            if len(held) > 8192:  # settle whole groups, keep the last one, which may go on
                last = len(held) - 1
                while last and held[last - 1][1] == held[-1][1]:
                    last -= 1
                if last:
                    yield settle(held[:last])
                    held = held[last:]
        if held:
            yield settle(held)

    lead = F.substring("right", 1, 24)
    return in_tasks(found.repartitionByRange(lead, "gram").sortWithinPartitions("gram").select("cid", "gram", "left", "right"), run, "cid long, low long, high long")


def hot_windows(found: DataFrame, length: int, gram: int) -> DataFrame:
    """(cid, low, high) for grams with too many contexts for a bucket, by hashes of their windows."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, left, right in zip(*(batch.column(c).to_pylist() for c in ("cid", "left", "right"))):
                body = np.frombuffer(left[::-1] + right, np.uint8)
                starts = np.arange(max(0, len(body) - length + 1))
                w1, w2 = (RollingHash(spread(body), b).of(starts, starts + length) for b in BASES[:2])
                n = len(starts)
                yield pa.RecordBatch.from_arrays([pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.full(n, cid)), pa.array(len(left) - starts)], ["w1", "w2", "cid", "d"])

    rows = in_tasks(found.select("cid", "left", "right"), run, "w1 long, w2 long, cid long, d long").where(F.col("d").between(0, reach))
    # at the same d, two contexts are two places; at different d they may overlap in one document
    twice = rows.groupBy("w1", "w2", "d").agg(F.min("cid").alias("c_low"), F.max("cid").alias("c_top")).where("c_low < c_top")
    twice = save(twice.select("w1", "w2", "d"), "windows")
    return rows.join(twice, ["w1", "w2", "d"]).groupBy("cid").agg(F.min("d").alias("low"), F.max("d").alias("high"))


# --- the operator --------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """(did, body, start, end) of the repeated bytes around each anchor; ``end`` may pass the text's end."""
    found = anchors(docs, length, gram)
    per_gram = found.groupBy("gram").agg(F.count("*").alias("n"), *[f(c).alias(f"{g}_{c}") for c in ("c1", "c2") for g, f in (("low", F.min), ("top", F.max))]).where("n > 1")
    mixed = (F.col("low_c1") != F.col("top_c1")) | (F.col("low_c2") != F.col("top_c2"))
    # written first: a join of two shuffled sides is split where a gram is hot, one with an aggregate is not
    per_gram = save(per_gram.select("gram", mixed.alias("mixed")), "grams")
    found = save(found.join(per_gram, "gram"), "anchors")
    per_context = found.where("mixed").groupBy("gram", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("did", "body", "pos")).alias("at"))
    per_context = save(per_context.select(F.monotonically_increasing_id().alias("cid"), "gram", "c1", "c2", "n", "at.*"), "contexts")
    kinds = per_context.groupBy("gram").agg(F.count("*").alias("kinds"))
    known = contexts(docs, per_context, length, gram)
    hot_grams = kinds.where(F.col("kinds") > hot).select("gram")
    if hot_grams.isEmpty():
        offsets = bucketed(known, length, gram)
    else:
        known = save(known, "context_bytes")
        offsets = bucketed(known.join(hot_grams, "gram", "left_anti"), length, gram).unionByName(hot_windows(known.join(hot_grams, "gram", "left_semi"), length, gram))
    alone = per_context.where("n = 1").join(offsets, "cid").select("did", "body", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("end"))
    reach = length - gram
    whole = lambda rows: rows.select("did", "body", F.greatest(F.col("pos") - reach, F.lit(0)).alias("start"), (F.col("pos") + length).alias("end"))
    often = found.where("mixed").join(per_context.where("n > 1").select("gram", "c1", "c2"), ["gram", "c1", "c2"])
    return whole(found.where("not mixed")).unionByName(whole(often)).unionByName(alone)


def cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Remove the spans of each text and join what is left."""
    for batch in batches:
        total, removed, runs, kept = [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            text = text.as_buffer().to_pybytes()
            ends = sorted((s["start"], min(s["end"], len(text))) for s in spans or ())
            stay, at, gone, n = [], 0, 0, 0
            low = high = -1
            for a, b in [*((a, b) for a, b in ends if b - a >= length), (len(text) + 1, len(text) + 1)]:
                if a <= high:
                    high = max(high, b)
                    continue
                if high > low:
                    stay.append(text[at:low])
                    at, gone, n = high, gone + high - low, n + 1
                low, high = a, b
            stay.append(text[at:])
            total.append(len(text)), removed.append(gone), runs.append(n), kept.append(b"".join(stay))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (total, removed, runs)), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of ``docs``; ``kept`` is the bytes that are left."""
    rows = keyed(docs)
    spans = repeated_spans(rows, length, gram or max(1, length * GRAM // LENGTH), hot)
    spans = spans.groupBy("did", "body").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return in_tasks(rows.join(spans, ["did", "body"], "left").select("doc_id", "text", "spans"), lambda batches: cut(batches, length), RESULT)
