"""Operator 7: MinHash near-deduplication by a multi-index Hamming join.

A document's set is its distinct word shingles (64-bit hashes). Equal sets are one *node*. Each node has
a signature of ``CHUNKS`` x ``CHUNK`` min-hash symbols of 16 bits. Two nodes whose signatures differ in at
most ``CHUNKS * (ERRORS + 1) - 1`` symbols differ, by the pigeonhole principle, in at most ``ERRORS``
symbols of some chunk; so each chunk gives a key for every way to leave ``ERRORS`` symbols out, and
all pairs under that distance meet under some key. With 8 chunks of 5 symbols and one error (distance up
to 15 of 40) a pair of Jaccard similarity 0.85 fails to meet once in 1.8 million, one of 0.8 once in 43,000.

Links are then confirmed on the full sets, without all pairs of a group:

1. Under each key all nodes are compared with one hub, the node that shares most with the groups it is
   in. Confirmed links give components.
2. Where a key still joins different components, the pairs of these *mixed* nodes that could be linked
   come from an exact prefix join: a node's shingles are ordered from rare to frequent among mixed nodes;
   two linked nodes share one of the first ``n - ceil(t n) + 1``, at places that leave room for the
   overlap which the threshold asks for. Only pairs across components are formed, and a token's largest
   component is never paired with itself.

Components come from rounds of joins over the confirmed links. Nothing but counts reaches the driver.

Defined results: without words or text (null too) the set is empty, its document is alone in its component; with
fewer words than a shingle has, the whole sequence is the one shingle; rows with null doc_id have part
in links but name no component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import in_tasks, mix64, save, slices, text_array
from stockroom.llm.words import Words, spaced

CHUNKS, CHUNK, ERRORS, RUN_BYTES = 8, 5, 1, 1 << 20
SIGNED = "doc_id long, did long, body long, n_shingles long, node binary, signature binary"
NO_ID = (1 << 63) - 1


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found = Words(texts, spaced())
    grams, whole = found.grams(words)
    out = []
    for i, (a, b) in enumerate(zip(found.at, found.at[1:])):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            few = mix64(np.array([hash_of(found.hash[a:b])], np.uint64))
            out.append(few)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def hash_of(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little")


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """n x symbols: 16 bits of the least value of each of CHUNKS * CHUNK hash functions over a set."""
    size = CHUNKS * CHUNK
    out = np.zeros((len(sets), size), np.uint16)
    some = [i for i, s in enumerate(sets) if len(s)]
    if some:
        flat = np.concatenate([sets[i] for i in some])
        at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in some])])[:-1]
        seeds = mix64(np.arange(1, 2 * size + 1, dtype=np.uint64))
        for k in range(size):
            least = np.minimum.reduceat((flat * (seeds[2 * k] | np.uint64(1)) + seeds[2 * k + 1]) ^ (flat >> np.uint64(29)), at)
            out[some, k] = (mix64(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, node, signature) of every row; node is the 128-bit hash of the set, null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                sets = shingle_sets(text_array(part.column("text")), words)
                node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                names = [r.tobytes() for r in signatures(sets)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("did"), part.column("body"), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), pa.array(names, pa.binary())], names=SIGNED.replace(",", " ").split()[::2]
                )

    return in_tasks(keyed(docs), run, SIGNED)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, did, body, text): a row with its key, doc_id (null greatest) and a hash of the text."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("body"), "text")


def chunk_keys(nodes: DataFrame) -> DataFrame:
    """(key, nid): for each chunk and each choice of symbols to leave out, a hash of the others."""
    kept = list(combinations(range(CHUNK), CHUNK - ERRORS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
            keys = np.empty((batch.num_rows, CHUNKS, len(kept)), np.uint64)
            for k, some in enumerate(kept):
                packed = np.zeros((batch.num_rows, CHUNKS), np.uint64)
                for s in some:
                    packed = mix64(packed * np.uint64(0x100000001B3) + symbols[:, :, s] + np.uint64(1))
                keys[:, :, k] = mix64(packed + np.arange(CHUNKS, dtype=np.uint64) * np.uint64(64) + np.uint64(k))
            where = pa.array(np.repeat(np.arange(batch.num_rows), CHUNKS * len(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), batch.column("nid").take(where)], ["key", "nid"])

    return in_tasks(nodes.select("nid", "signature"), run, "key long, nid long")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(nid, n, shingles) of the nodes of ``wanted`` (nid, did, body), computed from the texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                sets = shingle_sets(text_array(part.column("text")), words)
                yield pa.RecordBatch.from_arrays([part.column("nid"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["nid", "n", "shingles"])

    return in_tasks(keyed(docs).join(wanted, ["did", "body"]).select("nid", "text"), run, "nid long, n long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sets have 100 * intersection >= 100 * share * union."""
    hundredths = round(share * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) >= hundredths * max(len(x), len(y)):
                    at = np.searchsorted(x, y)
                    common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                    keep[i] = 100 * common >= hundredths * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    left = sets.select(F.col("nid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("nid").alias("b"), F.col("shingles").alias("sb"))
    return in_tasks(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(nid, comp) of every node of ``links`` (a, b): comp is the least node that can be reached.

    Each round takes the least label among a node and its neighbours, then the label of that label; the
    labels are written to the shared folder after each round. Labels only fall, so they are final when
    their sum no longer changes.
    """
    both = save(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = save(both.groupBy(F.col("a").alias("nid")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    total = None
    while True:
        offered = both.join(labels.select(F.col("nid").alias("b"), "comp"), "b").select(F.col("a").alias("nid"), "comp").unionByName(labels)
        step = offered.groupBy("nid").agg(F.min("comp").alias("comp"))
        jump = labels.select(F.col("nid").alias("comp"), F.col("comp").alias("further"))
        labels = save(step.join(jump, "comp", "left").select("nid", F.least("comp", "further").alias("comp")), "labels")
        before, total = total, labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels


def merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """(comp, final) of the components of ``labels`` (nid, comp) that the links ``more`` join; nodes without
    a label are their own component."""
    named = lambda side: labels.select(F.col("nid").alias(side), F.col("comp").alias(f"comp_{side}"))
    ends = more.join(named("a"), "a", "left").join(named("b"), "b", "left")
    ends = ends.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")).where("a <> b")
    return components(ends).select(F.col("nid").alias("comp"), F.col("comp").alias("final"))


def prefix_pairs(mixed: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """The pairs (a, b) of nodes of ``mixed`` (nid, comp) in different components that may be linked."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            for start in range(0, len(n), 64):
                part, size = batch.slice(start, 64), n[start : start + 64]
                where = pa.array(np.repeat(np.arange(len(size)), size))
                flat = np.frombuffer(b"".join(part.column("shingles").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), part.column("nid").take(where), part.column("n").take(where)], ["token", "nid", "n"])

    rows = in_tasks(sets.join(mixed.select("nid"), "nid"), tokens, "token long, nid long, n long")
    shared = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    per_node = rows.join(shared, "token").groupBy("nid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("live"))
    # shingles that no other mixed node has come first in the order and need no row
    hundredths = round(share * 100)
    need = F.ceil(F.col("n") * hundredths / 100)
    per_node = per_node.where(F.size("live") >= need)
    prefix = (
        per_node.select("nid", "n", (F.col("n") - F.size("live")).alias("alone"), (F.col("n") - need + 1).alias("length"), "live")
        .select("nid", "n", "alone", F.posexplode(F.slice("live", F.lit(1), F.greatest(F.col("length") - F.col("alone"), F.lit(0)).cast("int"))).alias("i", "item"))
        .select("nid", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("room"), F.col("item.token").alias("token"))
    )
    sizes = mixed.groupBy("comp").agg(F.count("*").alias("members"))
    prefix = save(prefix.join(mixed.join(sizes, "comp").select("nid", F.struct("members", "comp").alias("rank")), "nid"), "prefix")
    largest = prefix.groupBy("token").agg(F.max("rank").alias("top"), F.min("rank").alias("low")).where("low < top").select("token", "top")
    left = prefix.join(largest, "token").where("rank < top").select("token", *[F.col(c).alias(f"{c}_a") for c in ("nid", "n", "room", "rank")])
    right = prefix.select("token", *[F.col(c).alias(f"{c}_b") for c in ("nid", "n", "room", "rank")])
    least_ = F.col("n_a") + F.col("n_b")
    fits = (
        (F.col("rank_a") < F.col("rank_b"))
        & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * hundredths)
        & (F.least("room_a", "room_b") * (100 + hundredths) >= least_ * hundredths)
    )
    met = left.join(right, (left["token"] == right["token"]) & fits)
    return met.select(F.least("nid_a", "nid_b").alias("a"), F.greatest("nid_a", "nid_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """(doc_id, did, body, n_shingles, component_id, stays, kept) of every row of ``docs``. ``kept`` marks the rows
    of the smallest doc_id of a component, ``stays`` one text of each component: that of the smallest doc_id,
    by hash among several, or of some row if no row has a doc_id."""
    rows = save(signed(docs, words), "signed")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("did", "body")).alias("rep"), F.min("signature").alias("signature")
    )
    nodes = save(nodes.select(F.monotonically_increasing_id().alias("nid"), "node", "first_id", "rep.*", "signature"), "nodes")
    keys = chunk_keys(nodes)
    met = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = save(keys.join(met, "key"), "met")
    weight = met.groupBy("nid").agg(F.sum("members").alias("weight"))
    hubs = met.join(weight, "nid").groupBy("key").agg(F.max(F.struct("weight", "nid"))["nid"].alias("hub"))
    star = met.join(hubs, "key").where("nid <> hub").select(F.col("nid").alias("a"), F.col("hub").alias("b")).distinct()
    sets = save(full_sets(docs, nodes.join(met.select("nid").distinct(), "nid").select("nid", "did", "body"), words).dropDuplicates(["nid"]), "sets")
    links = save(confirmed(star, sets, share), "star")
    labels = components(links)
    grouped = met.select("key", "nid").join(labels, "nid", "left").withColumn("comp", F.coalesce("comp", "nid"))
    mixed = grouped.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("top")).where("low < top")
    mixed = save(grouped.join(mixed.select("key"), "key").select("nid", "comp").distinct(), "mixed")
    more = save(confirmed(prefix_pairs(mixed, sets, share), sets, share), "more")
    placed = nodes.join(labels, "nid", "left").withColumn("comp", F.coalesce("comp", "nid")).withColumn("rep", F.struct("did", "body"))
    placed = placed.join(merged(labels, more), "comp", "left").select("node", "first_id", "rep", F.coalesce("final", "comp").alias("comp"))
    least = placed.groupBy("comp").agg(F.min("first_id").alias("component_id"), F.min("rep").alias("rep"))
    named = placed.drop("rep").join(least, "comp").select("node", "component_id", "rep")
    out = rows.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    stays = F.col("node").isNull() | (F.struct("did", "body") == F.col("rep"))
    out = out.select("doc_id", "did", "body", "n_shingles", component.alias("component_id"), stays.alias("stays"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns.

    Rows with the same doc_id and text stay or go together.
    """
    stay = near_duplicates(docs, words, share).where("stays").select("did", "body").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    doc_id, text = F.col("doc.doc_id").cast("long"), F.coalesce(F.col("doc.text"), F.lit(""))
    whole = whole.withColumn("did", F.coalesce(doc_id, F.lit(NO_ID))).withColumn("body", F.xxhash64(text))
    return whole.join(stay, ["did", "body"], "left_semi").select("doc.*")
