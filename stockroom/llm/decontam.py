"""Operator 6: benchmark decontamination by seeds of word pairs and Smith-Waterman alignment.

Words are runs of letters and digits (of any script), A-Z lower-cased; in scripts without spaces, such as
Chinese, Japanese and Thai, each character is a word. A document is contaminated if its local alignment with an item by Smith-Waterman over words (match 2, mismatch and gap -1)
scores ``THRESHOLD`` or more of the item's alignment with itself. Seeds say where to align, and lose none:

* A seed is a pair of words of the item, next to each other or with one between, that the document has
  next to each other or with one between; it weighs 2 if next to each other in both, else 1.
* Neighbouring matches of an alignment with no error between them are a seed of weight 2, with one error
  of weight 1. M matches and E errors score 2M - E, so for T = ``THRESHOLD`` and an item of L words
  E <= 2M - 2TL, and the seeds of its M - 1 steps weigh 2(M - 1) - E >= 2TL - 2 together.
* The alignment has at most M + E <= (3 - 2T)L words of the document.

So a document is aligned with an item where a stretch of that many words has seeds of that weight, and
nowhere else. At most two of a place's weight come from one place of the item, so seeds lie at TL - 1 places
or more. The rarest in the benchmark are looked up first: so many places that even if all that may be missing were
among them, 1 + ``MORE`` of the others would be found. What has fewer is no candidate. No seed is dropped because
many documents hold it.

Items travel to the tasks in blocks of at most ``BLOCK_WORDS`` words, a pass over the documents each, so
what is broadcast is bounded whatever the size of the benchmark. A document is scored in the task that
reads it: nothing is shuffled, and no document or item can be hot.

Defined results: on equal scores the first stretch of a document counts, in it the alignment that ends at the first word
of the item, then of the text, and its start is found from there backwards by the same rule; texts that are null or without words match nothing; an item of fewer than ``SEED``
words matches only where it stands whole; repeated rows, documents or items, give their rows each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockroom.llm.common import in_tasks, mix64, save, slices, text_array
from stockroom.llm.words import Words, alphanumeric

SEED, THRESHOLD, BLOCK_WORDS, RUN_BYTES = 4, 0.5, 1_000_000, 1 << 20
#: The share of the further places that is looked up too, so that one seed alone makes no candidate.
MORE = 0.15
HITS = "doc_id long, item_id long, score double, n_seeds long, start long, end long"


def pairs(found: Words, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the word at each place with the word ``step`` places on, and whether that is in its text."""
    n = len(found.hash)
    out = np.zeros(n, np.uint64)
    out[: max(0, n - step)] = mix64(mix64(found.hash[: max(0, n - step)]) * np.uint64(0x100000001B3) + found.hash[step:])
    return out, np.arange(n) < np.repeat(found.at[1:], np.diff(found.at)) - step


def ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers first .. first + many - 1 of each row, joined."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


class Items:
    """Test items as arrays of word hashes, with their seeds.

    ``distinct`` are the seed pairs of all items of SEED words or more, sorted; ``near`` and ``far`` number
    the pair of each place of an item (from ``at`` on) with the next word and the one after it (-1 if there is
    none). ``rare`` are the items to try for a pair, from ``rare_at`` on. ``whole`` has, for each size of shorter
    items, their grams, sorted, beside the items."""

    def __init__(self, ids: list[int], texts: list[bytes], threshold: float):
        self.ids = ids
        found = Words(pa.array(texts, pa.binary()), alphanumeric())
        sizes = np.diff(found.at)
        self.words = [found.hash[a:b] for a, b in zip(found.at, found.at[1:])]
        self.whole = {}
        for size in range(1, SEED):
            own = np.flatnonzero(sizes == size)
            gram = found.grams(size)[0][found.at[own]]
            order = np.argsort(gram, kind="stable")
            if len(own):
                self.whole[size] = gram[order], own[order]
        item = np.repeat(np.arange(len(ids)), sizes)
        steps = [pairs(found, step) for step in (1, 2)]
        steps = [(gram, whole & (sizes[item] >= SEED)) for gram, whole in steps]
        self.distinct, number = np.unique(np.concatenate([gram[whole] for gram, whole in steps]), return_inverse=True)
        self.at = found.at
        self.near, self.far = (np.full(len(item), -1, np.int64) for _ in steps)
        self.near[steps[0][1]], self.far[steps[1][1]] = np.split(number, [steps[0][1].sum()])
        self.need = 2 * threshold * sizes - 2 - 1e-9
        # an alignment that reaches the threshold has seeds at all places but `spare`, so at `least` of the rarest
        used = np.append(np.bincount(number, minlength=len(self.distinct)), 0)
        rarity = used[self.near] + used[self.far]
        places, self.least = [], np.ones(len(ids), np.int64)
        for i in np.flatnonzero(sizes >= SEED):
            spare = sizes[i] - 1 - max(1, int(np.ceil(self.need[i] / 2)))
            self.least[i] = 1 + int(MORE * (sizes[i] - 2 - spare))
            places.append(found.at[i] + np.argsort(rarity[found.at[i] : found.at[i + 1] - 1], kind="stable")[: spare + self.least[i]])
        places = np.concatenate(places) if places else np.empty(0, np.int64)
        tried = np.unique(np.concatenate([np.stack([x[places], places]) for x in (self.near, self.far)], axis=1), axis=1)
        tried = tried[:, tried[0] >= 0]
        self.owner, self.rare_place = item, tried[1]
        self.rare_at = np.searchsorted(tried[0], np.arange(len(self.distinct) + 1))


def blocks(benchmark: DataFrame, threshold: float) -> Iterator[Items]:
    """The items in blocks of bounded size."""
    if threshold * SEED <= 1:
        raise ValueError(f"threshold must be above 1/{SEED}: below, an item of {SEED} words is reached without a seed")
    ids, texts, words = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        ids.append(row["item_id"]), texts.append(row["text"].encode())
        words += len(texts[-1]) // 2 + 1
        if words >= BLOCK_WORDS:
            yield Items(ids, texts, threshold)
            ids, texts, words = [], [], 0
    if ids:
        yield Items(ids, texts, threshold)


def align(item: np.ndarray, words: np.ndarray) -> tuple[float, int]:
    """Smith-Waterman: the best local score of ``item`` against ``words``, and the word it ends before."""
    best, end = 0.0, 0
    row = np.zeros(len(words) + 1)
    step = np.arange(len(words) + 1, dtype=np.float64)
    for word in item:
        new = np.zeros(len(words) + 1)
        new[1:] = np.maximum(row[:-1] + np.where(words == word, 2.0, -1.0), row[1:] - 1.0)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + step) - step
        at = int(row.argmax())
        if row[at] > best:
            best, end = float(row[at]), at
    return best, end


def rarest(doc: np.ndarray, which: np.ndarray, items: Items) -> np.ndarray:
    """text * items + item of those texts that have, of the rarest places of an item, as many as an alignment must.
    The pairs ``which`` are found in the texts ``doc``, in ascending order; texts are taken a few at a time."""
    many = items.rare_at[which + 1] - items.rare_at[which]
    out = [np.empty(0, np.int64)]
    ends = np.flatnonzero(np.diff(doc, append=-1)) + 1
    total = np.cumsum(many)[ends - 1] if len(ends) else ends
    cuts = np.append(0, ends[np.flatnonzero(np.diff(total // RUN_BYTES, append=-1))])
    for a, b in zip(cuts, cuts[1:]):
        at = ranges(items.rare_at[which[a:b]], many[a:b])
        # a place counts once, though both of its pairs may be there
        place = np.unique(np.repeat(doc[a:b], many[a:b]) * len(items.near) + items.rare_place[at])
        owner = place // len(items.near) * len(items.words) + items.owner[place % len(items.near)]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        held = np.diff(np.append(first, len(owner)))
        owner = owner[first]
        out.append(owner[held >= items.least[owner % len(items.words)]])
    return np.concatenate(out)


def candidates(hits: list[tuple[np.ndarray, np.ndarray]], items: Items) -> np.ndarray:
    """(text, item) as rows of two, sorted: those whose seeds, anywhere in the text, are enough for the threshold.
    ``hits`` are the texts and numbers of the pairs found with the next word and with the one after it."""
    n = len(items.distinct)
    sets = [np.unique(doc * n + which) for doc, which in hits]
    both = np.union1d(*sets)
    tried = rarest(both // n, both % n, items)
    doc, item = tried // len(items.words), tried % len(items.words)
    sizes = np.diff(items.at)[item]
    has = lambda keys, part: part[np.minimum(np.searchsorted(part, keys), len(part) - 1)] == keys if len(part) else np.zeros(len(keys), bool)
    enough = np.zeros(len(tried), bool)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum(), RUN_BYTES)[1:], side="right")
    for part in np.split(np.arange(len(tried)), cuts):
        if not len(part):
            continue
        place = ranges(items.at[item[part]], sizes[part])
        base = np.repeat(doc[part], sizes[part]) * n
        near, far = items.near[place], items.far[place]
        next_, after = (near >= 0) & has(base + near, sets[0]), np.zeros(len(place), bool)
        for pair, set_ in ((near, sets[1]), (far, sets[0]), (far, sets[1])):
            after |= (pair >= 0) & has(base + pair, set_)
        weight = np.add.reduceat(np.where(next_, 2, after), np.cumsum(sizes[part]) - sizes[part])
        enough[part] = weight >= items.need[item[part]]
    return np.stack([doc[enough], item[enough]], axis=1)


def passages(place: np.ndarray, weight: np.ndarray, need: float, span: int, n: int) -> Iterator[tuple[int, int]]:
    """Word ranges of a document of n words that hold every stretch of ``span`` words whose seeds, at the
    sorted places ``place``, have a weight of ``need`` or more."""
    total = np.concatenate([[0], np.cumsum(weight)])
    start = place[total[np.searchsorted(place, place + span)] - total[:-1] >= need]
    if len(start):
        for rows in np.split(start, np.flatnonzero(np.diff(start) > span) + 1):
            yield int(rows[0]), min(n, int(rows[-1]) + span)


def matches(found: Words, items: Items, threshold: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(text, item, score, seeds, first word, end word) of the best passage of each text and item that reaches
    the threshold."""
    for size, (grams, owners) in items.whole.items():
        gram, whole = found.grams(size)
        place = np.flatnonzero(whole & np.isin(gram, grams))
        first, end = (np.searchsorted(grams, gram[place], side) for side in ("left", "right"))
        doc = np.repeat(np.searchsorted(found.at, place, side="right") - 1, end - first)
        own, place = owners[ranges(first, end - first)], np.repeat(place, end - first)
        for k in np.unique(np.stack([doc, own]), axis=1, return_index=True)[1]:
            yield int(doc[k]), int(own[k]), 1.0, 1, int(place[k]), int(place[k]) + size
    if not len(items.distinct):
        return
    hits = []
    for step in (1, 2):
        gram, whole = pairs(found, step)
        at = np.minimum(np.searchsorted(items.distinct, gram), len(items.distinct) - 1)
        place = np.flatnonzero(whole & (items.distinct[at] == gram))
        hits.append((place, at[place], np.searchsorted(found.at, place, side="right") - 1))
    for d, i in candidates([(doc, which) for _, which, doc in hits], items).tolist():
        start, stop = int(found.at[d]), int(found.at[d + 1])
        target = items.words[i]
        near, far = (x[items.at[i] : items.at[i + 1]] for x in (items.near, items.far))
        seeds = []
        for step, (place, which, doc) in enumerate(hits, 1):
            low, high = np.searchsorted(doc, [d, d + 1])
            which, place = which[low:high], place[low:high] - start
            for pair, weight in ((near, 2 if step == 1 else 1), (far, 1)):
                rows = np.isin(which, pair)
                seeds.append((place[rows], np.full(rows.sum(), weight), which[rows]))
        place, weight, which = (np.concatenate(x) for x in zip(*seeds))
        places, group = np.unique(place, return_inverse=True)
        most = np.zeros(len(places), np.int64)
        np.maximum.at(most, group, weight)
        best = None
        # an alignment that reaches the threshold is no longer than this
        span = int(len(target) * (3 - 2 * threshold) + 1e-9)
        for low, high in passages(places, most, items.need[i], span, stop - start):
            words = found.hash[start + low : start + high]
            # no alignment can match more words than occur in both
            if np.isin(target, words).sum() < threshold * len(target):
                continue
            score, end = align(target, words)
            score /= 2 * len(target)
            if score >= threshold and (best is None or score > best[2]):
                back = align(target[::-1], words[:end][::-1])[1]
                inside = which[(place >= low) & (place < high)]
                n = int((np.isin(near, inside) | np.isin(far, inside)).sum())
                best = (d, i, score, n, start + low + end - back, start + low + end)
        if best:
            yield best


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, n_seeds, start, end) of every document and item that it holds; start and end
    are code points of the best passage. Clean documents have no row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for items in blocks(benchmark, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for part in slices(batch, most=RUN_BYTES):
                    found = Words(text_array(part.column("text")), alphanumeric())
                    heads = None
                    rows = []
                    for d, i, score, n, a, b in matches(found, own, threshold):
                        if heads is None:
                            heads = np.concatenate([[0], np.cumsum((found.body & 0xC0) != 0x80)])
                        base = heads[found.cuts[d]]
                        rows.append((part.column("doc_id")[d].as_py(), own.ids[i], score, n, int(heads[found.start[a]] - base), int(heads[found.end[b - 1]] - base)))
                    if rows:
                        names = HITS.replace(",", " ").split()[::2]
                        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

        hits = in_tasks(docs, run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return docs.sparkSession.createDataFrame([], HITS) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    for items in blocks(benchmark, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, most=RUN_BYTES):
                    found = Words(text_array(part.column("text")), alphanumeric())
                    keep = np.ones(part.num_rows, bool)
                    keep[[d for d, *_ in matches(found, shared.value, threshold)]] = False
                    yield pa.RecordBatch.from_arrays([part.column("doc")], ["doc"]).filter(pa.array(keep))

        rows = save(in_tasks(rows.select("doc", F.col("doc.text").alias("text")), run, StructType([rows.schema["doc"]])), "clean")
    return rows.select("doc.*")
