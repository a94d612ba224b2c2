"""Operator 2: personal data by patterns, and terms that give protected entities away.

The base spans are emails, IPv4 addresses, card numbers (Luhn) and phone numbers, each kind leftmost and
non-overlapping over the whole text. Their values are the protected entities. What else reveals an entity
is estimated from the corpus: for an entity e and a term t among the ``WINDOW`` words on either side of e,
with document counts n, the information that t gives away about e is

    disclosure(t, e) = PMI(t; e) / IC(e) = 1 - log2(n(t) / n(t, e)) / log2(N / n(e)),

1 if t occurs only with e. Terms whose disclosure reaches ``GENERALISE`` in at least ``SUPPORT`` documents
become spans of kind ``term`` wherever they occur; a clean text has entities and terms of disclosure
``REMOVE`` or more removed, other terms generalised to their kind of word.

Counts cover all documents. Only rows around entities and rows of terms that may matter are shuffled: the
terms seen with an entity in ``SUPPORT`` documents, then the terms to be marked, are put into a Bloom
filter of fixed size (``BLOOM_BITS``), which picks words in the tasks that read the texts; exact joins
follow. A fuller filter lets more words through, never fewer. Counts are summed per batch first, so a
word that a third of all documents hold is a row per batch.

Defined results: a null text counts as empty; rows with the same doc_id and text get the same spans;
offsets are code points, the end exclusive; a term within a base span is not marked again; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import in_tasks, save, slices, text_array
from stockroom.llm.words import Words, alphanumeric

KINDS = ("email", "ip", "card", "phone")
WINDOW, SUPPORT, GENERALISE, REMOVE, MIN_BYTES = 5, 3, 0.9, 1.0, 3
BLOOM_BITS, RUN_BYTES, NO_ID = 1 << 23, 2 << 20, -(1 << 63)

#: What may stand before and after the @ of an email, and the other base patterns (fixed by the rules;
#: possessive, as giving back characters cannot make them match).
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
FOUND = "doc_id long, did long, body long, n_email long, n_ip long, n_card long, n_phone long, base string, near array<struct<entity: long, term: long>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping emails, in time linear in the text: from each @ back over what may stand
    before it, and forward over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = done + len(text[done:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if len(m[0]) >= 13:
            digits = [ord(c) - 48 for c in m[0] if c not in " -"]
            if 13 <= len(digits) <= 19:
                doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
                if (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0:
                    yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


FINDERS = (emails, addresses, cards, phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind, then start."""
    return [(k, a, b) for k, find in enumerate(FINDERS) for a, b in find(text)]


def entity(kind: int, value: str) -> int:
    """A number for a protected value; its spelling (case, blanks, separators) does not matter."""
    plain = value.lower() if kind < 2 else "".join(c for c in value if "0" <= c <= "9")
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest(), "little", signed=True)


def near_terms(text: str, spans: list[tuple[int, int, int]]) -> set[tuple[int, int]]:
    """(entity, term) for the words on either side of each span; words of other spans are no terms."""
    found = Words(pa.array([text.encode()], pa.binary()), alphanumeric())
    byte_of = np.append(np.flatnonzero((found.body & 0xC0) != 0x80), len(found.body))
    ok = terms(found)
    covered = np.zeros(len(found.hash), bool)
    cuts = []
    for _, a, b in spans:
        low, high = np.searchsorted(found.end, byte_of[a], side="right"), np.searchsorted(found.start, byte_of[b], side="left")
        covered[low:high] = True
        cuts.append((low, high))
    ok &= ~covered
    out = set()
    for (kind, a, b), (low, high) in zip(spans, cuts):
        who = entity(kind, text[a:b])
        for side in (range(max(0, low - WINDOW), low), range(high, min(len(ok), high + WINDOW))):
            out.update((who, int(found.hash[i].view(np.int64))) for i in side if ok[i])
    return out


def terms(found: Words) -> np.ndarray:
    """Which words can be terms: of ``MIN_BYTES`` or more, and not begun by a digit."""
    if not len(found.hash):
        return np.zeros(0, bool)
    first = found.body[found.start]
    return (found.end - found.start >= MIN_BYTES) & ((first < 48) | (first > 57))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, did, body, text): a row with its key, doc_id (null smallest) and a hash of the text."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("body"), text.alias("text"))


def base(rows: DataFrame) -> DataFrame:
    """Counts and base spans of every row, and the terms near its entities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spelled, near = [[], [], [], []], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                for k in range(4):
                    counts[k].append(sum(s[0] == k for s in spans))
                spelled.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans))
                near.append([{"entity": e, "term": t} for e, t in sorted(near_terms(text, spans))] if spans else [])
            kind = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "did", "body")), *(pa.array(c, pa.int64()) for c in counts), pa.array(spelled, pa.string()), pa.array(near, kind)],
                names=["doc_id", "did", "body", *(f"n_{k}" for k in KINDS), "base", "near"],
            )

    return in_tasks(rows, run, FOUND)


class Bloom:
    """A set of 64-bit hashes in a fixed number of bits: may say yes wrongly, never no."""

    def __init__(self, hashes: DataFrame):
        """``hashes`` has one long column; at most BLOOM_BITS / 64 rows reach the driver."""
        name = hashes.columns[0]
        at = F.explode(F.array(F.col(name).bitwiseAND(BLOOM_BITS - 1), F.shiftrightunsigned(name, 30).bitwiseAND(BLOOM_BITS - 1))).alias("at")
        bits = hashes.select(at).select(F.shiftright("at", 6).alias("cell"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
        self.cells = np.zeros(BLOOM_BITS // 64, np.uint64)
        for row in bits.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
            self.cells[row["cell"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in (hashes & np.uint64(BLOOM_BITS - 1), (hashes >> np.uint64(30)) & np.uint64(BLOOM_BITS - 1)):
            out &= (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def term_documents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n_term): the number of rows whose text holds each term of ``wanted`` (term)."""
    shared = rows.sparkSession.sparkContext.broadcast(Bloom(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                found = Words(text_array(part.column("text")), alphanumeric())
                hit = np.flatnonzero(shared.value.has(found.hash) & terms(found))
                doc = np.searchsorted(found.at, hit, side="right") - 1
                order = np.lexsort((doc, found.hash[hit]))
                word, doc = found.hash[hit][order], doc[order]
                new = np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])]) if len(word) else np.zeros(0, bool)
                term, n = np.unique(word[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])

    counts = in_tasks(rows.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    return counts.join(wanted, "term", "left_semi")


def disclosing(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(term, disclosure) of the terms that reveal an entity: the greatest over entities."""
    near = found.select(F.explode("near").alias("x")).select("x.*")
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= SUPPORT)
    pairs = save(pairs, "pairs")
    held = found.where(F.size("near") > 0).select(F.explode(F.array_distinct(F.col("near.entity"))).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    total = found.count()
    seen = term_documents(rows, pairs.select("term").distinct())
    pairs = pairs.join(held, "entity").join(seen, "term").where(F.col("n_entity") < total)
    # a count of t near e never exceeds that of t, or of e
    share = 1 - F.log2(F.col("n_term") / F.col("n_both")) / F.log2(F.lit(total) / F.col("n_entity"))
    return pairs.withColumn("disclosure", share).where(F.col("disclosure") >= GENERALISE).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def occurrences(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """(did, body, terms) of the rows whose text holds terms of ``marked``: code point spans with disclosure."""
    shared = rows.sparkSession.sparkContext.broadcast(Bloom(marked.select("term")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                found = Words(text_array(part.column("text")), alphanumeric())
                hit = np.flatnonzero(shared.value.has(found.hash) & terms(found))
                doc = np.searchsorted(found.at, hit, side="right") - 1
                heads = np.concatenate([[0], np.cumsum((found.body & 0xC0) != 0x80)])
                start, end = (heads[x[hit]] - heads[found.cuts[doc]] for x in (found.start, found.end))
                where = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column("did").take(where), part.column("body").take(where), pa.array(found.hash[hit].view(np.int64)), pa.array(start), pa.array(end)], ["did", "body", "term", "start", "end"])

    hits = in_tasks(rows.select("did", "body", "text"), run, "did long, body long, term long, start long, end long").join(marked, "term")
    return hits.groupBy("did", "body").agg(F.array_sort(F.collect_set(F.struct("start", "end", "disclosure"))).alias("terms"))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, did, body, n_email, n_ip, n_card, n_phone, base, spans, removed) of every row of ``docs``: base
    spans and all spans as comma-joined kind:start:end, and the term spans to be removed likewise."""
    rows = keyed(docs)
    found = save(base(rows), "found")
    marked = save(disclosing(rows, found), "terms")
    kinds = "spans string, removed string"
    fixed = FOUND.replace(", near array<struct<entity: long, term: long>>", "")
    if marked.isEmpty():
        joined = found.withColumn("terms", F.expr("cast(array() as array<struct<start: long, end: long, disclosure: double>>)"))
    else:
        joined = found.join(occurrences(rows, marked), ["did", "body"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = fixed.replace(",", " ").split()[::2]
        for batch in batches:
            every, gone = [], []
            for base_, more in zip(batch.column("base").to_pylist(), batch.column("terms").to_pylist()):
                taken = sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in base_.split(",")) if more and base_ else []
                at, clear = 0, []
                reach = -1
                for t in more or ():
                    while at < len(taken) and taken[at][0] < t["end"]:
                        reach = max(reach, taken[at][1])
                        at += 1
                    if reach <= t["start"]:
                        clear.append(t)
                spelled = [f"term:{t['start']}:{t['end']}" for t in clear]
                every.append(",".join([*([base_] if base_ else []), *spelled]))
                gone.append(",".join(s for s, t in zip(spelled, clear) if t["disclosure"] >= REMOVE))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(every, pa.string()), pa.array(gone, pa.string())], [*names, "spans", "removed"])

    return in_tasks(joined.select(*fixed.replace(",", " ").split()[::2], "terms"), run, f"{fixed}, {kinds}")


def sanitised(docs: DataFrame) -> DataFrame:
    """(doc_id, clean) of every row of ``docs``: base spans and removed terms replaced by their kind in square
    brackets, other terms by [word] or, if capitalised, [name]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, marks, gone in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "removed"))):
                gone, parts, done = set(gone.split(",")), [], 0
                rows = sorted((int(m.split(":")[1]), int(m.split(":")[2]), m) for m in marks.split(",") if m)
                for a, b, mark in rows:
                    if b <= done:
                        continue
                    kind = mark.split(":")[0]
                    if kind == "term" and mark not in gone:
                        kind = "name" if text[a].isupper() else "word"
                    parts += [text[done:a], f"[{kind}]"]
                    done = b
                out.append("".join([*parts, text[done:]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "clean"])

    # rows of one key have one text, so a key's spans are wanted once
    marks = spans(docs).select("did", "body", "spans", "removed").dropDuplicates(["did", "body"])
    return in_tasks(keyed(docs).join(marks, ["did", "body"]).select("doc_id", "text", "spans", "removed"), run, "doc_id long, clean string")
