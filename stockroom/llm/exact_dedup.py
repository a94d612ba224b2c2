"""Operator 1: exact deduplication against a minimal perfect hash over known digests.

The digests of all texts seen so far are kept in an *index*: its shards hold, for a share of the digest
space each, a minimal perfect hash (levels of bit arrays, a key's place being the rank of its bit) and
one slot per digest with the full 32-byte digest and the locator (doc_id, row id) of the row that stays.
The digests of new rows probe their shards. A perfect hash sends strangers to some slot as well, so the
slot's digest is compared byte by byte: equal means a repeat, different means a nonmember. Nonmembers
are grouped among themselves and can be added to the index.

``dedup`` takes a table as ``BATCHES`` batches, each of which meets the index of those before it: its repeats
are counted in their slots and move the locator to the larger row, its nonmembers become a further
generation of the index. In the end every digest has one slot, and its rows get what that slot says.

Skew: digests are aggregated before any shuffle, so a text that a third of all rows share is one row per
task in the build, and each distinct digest is probed once. The answers are joined to the rows by digest, with
two written sides, so that Spark's skew join splits the rows of a hot digest. A shard holds about ``SLOTS`` digests whatever the size of the corpus; only the number of shards grows.

Defined results: a null text counts as empty; texts are equal when identical after lower-casing A-Z;
the largest doc_id stays (null counts as smallest), and among rows with the same doc_id and text the
one with the largest row id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import in_tasks, lower_az, mix64, save, with_row_id

#: Batches that a table is taken in.
BATCHES = 2
#: Digests that a shard holds on average.
SLOTS = 4096
#: Bits of a level per key that is left when it is built.
SPARE = 1.5
ROW = "rid long, doc_id long, digest binary"
INDEX = "shard long, levels array<long>, bits binary, digests binary, doc_ids binary, rids binary, counts binary"
MARKED = "digest binary, doc_id long, rid long, count long, repeat boolean"
FOUND = "digest binary, keep_id long, keep_rid long, group_size long"
PROBED = "digest binary, keep_id long, keep_rid long, group_size long, repeat boolean"
NO_ID = -(1 << 63)


def digests(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, digest) of every row; the digest is SHA-256 of the normalised text in UTF-8."""
    digest = F.unhex(F.sha2(F.encode(lower_az(F.col("text")), "UTF-8"), 256)).alias("digest")
    return save(with_row_id(docs, F.col("doc_id").cast("long").alias("doc_id"), digest), "digests")


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: the locator of the row that stays and the number of rows."""
    locator = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("rid"))
    return rows.groupBy("digest").agg(F.max(locator).alias("keep"), F.count("*").alias("count")).select("digest", "keep.*", "count")


def shard_of(shards: int):
    """The shard of a digest from its first eight bytes."""
    return F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long") % F.lit(shards)


def build_index(distinct: DataFrame, shards: int) -> DataFrame:
    """The index of ``distinct`` (digest, doc_id, rid, count), one row per shard."""
    return distinct.withColumn("shard", shard_of(shards)).groupBy("shard").applyInArrow(_build, INDEX)


def _words(digests_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = digests_.view(np.uint64).reshape(-1, 4)
    return w[:, 2].copy(), w[:, 3].copy()


def _place(words: tuple[np.ndarray, np.ndarray], level: int, bits: int) -> np.ndarray:
    a, b = words
    seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(a ^ (b * np.uint64(2 * level + 1)) ^ seed) % np.uint64(bits)).astype(np.int64)


def perfect_hash(digests_: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the joined bits of a minimal perfect hash of distinct 32-byte digests (n x 32)."""
    words = _words(digests_)
    left, sizes, arrays = np.arange(len(digests_)), [], []
    while len(left):
        bits = max(8, int(len(left) * SPARE))
        at = _place((words[0][left], words[1][left]), len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        sizes.append(bits)
        arrays.append(alone)
        left = left[~alone[at]]
        if len(sizes) > 200:
            raise ValueError("digests are not distinct")
    return sizes, np.concatenate(arrays) if arrays else np.empty(0, bool)


def slots_of(sizes: list[int], bits: np.ndarray, digests_: np.ndarray) -> np.ndarray:
    """The slot of each digest; some slot, or -1, for digests that are not members."""
    words, rank = _words(digests_), np.cumsum(bits) - 1
    out = np.full(len(digests_), -1, np.int64)
    left, base = np.arange(len(digests_)), 0
    for level, size in enumerate(sizes):
        at = base + _place((words[0][left], words[1][left]), level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def _digest_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _build(group: pa.Table) -> pa.Table:
    keys = _digest_rows(group["digest"])
    sizes, bits = perfect_hash(keys)
    order = np.empty(len(keys), np.int64)
    order[slots_of(sizes, bits, keys)] = np.arange(len(keys))
    number = lambda name: group[name].to_numpy()[order].astype("<i8").tobytes()
    return pa.Table.from_pydict(
        {
            "shard": [group["shard"][0].as_py()],
            "levels": pa.array([sizes], pa.list_(pa.int64())),
            "bits": [np.packbits(bits).tobytes()],
            "digests": [keys[order].tobytes()],
            "doc_ids": [number("doc_id")],
            "rids": [number("rid")],
            "counts": [number("count")],
        }
    )


def probe(distinct: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Look up the digests of ``distinct`` (digest, doc_id, rid, count) in the index: the row that stays and the
    number of rows by the index, or for digests that are not in it those of ``distinct``."""
    asked = distinct.withColumn("shard", shard_of(shards))
    return asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe, PROBED)


def _members(asked: pa.Table, shard: dict) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each digest asked for, and whether that slot holds the digest."""
    held = np.frombuffer(shard["digests"], np.uint8).reshape(-1, 32)
    bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8)).astype(bool)[: sum(shard["levels"])]
    keys = _digest_rows(asked["digest"])
    at = slots_of(shard["levels"], bits, keys)
    return at, (at >= 0) & (held[at] == keys).all(axis=1)


def _shard(index: pa.Table) -> dict:
    return {name: index[name][0].as_py() for name in index.column_names}


def _digest_column(asked: pa.Table) -> pa.Array:
    return asked["digest"].combine_chunks().cast(pa.binary()) if asked.num_rows else pa.array([], pa.binary())


def _probe(asked: pa.Table, index: pa.Table) -> pa.Table:
    n = asked.num_rows
    member = np.zeros(n, bool)
    out = [asked[name].to_numpy() for name in ("doc_id", "rid", "count")]
    if n and index.num_rows:
        shard = _shard(index)
        at, member = _members(asked, shard)
        out = [np.where(member, np.frombuffer(shard[name], "<i8")[at], own) for name, own in zip(("doc_ids", "rids", "counts"), out)]
    return pa.Table.from_arrays([_digest_column(asked), *(pa.array(x, pa.int64()) for x in out), pa.array(member)], names=["digest", "keep_id", "keep_rid", "group_size", "repeat"])


def mark(distinct: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``distinct`` (digest, doc_id, rid, count) with ``repeat``, whether the index holds the digest."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        member = _members(asked, _shard(held))[1] if asked.num_rows and held.num_rows else np.zeros(asked.num_rows, bool)
        numbers = [pa.array(asked[name].to_numpy(), pa.int64()) for name in ("doc_id", "rid", "count")]
        return pa.Table.from_arrays([_digest_column(asked), *numbers, pa.array(member)], names=["digest", "doc_id", "rid", "count", "repeat"])

    asked = distinct.withColumn("shard", shard_of(shards))
    return asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(run, MARKED)


def absorb(index: DataFrame, repeats: DataFrame, shards: int) -> DataFrame:
    """The index after ``repeats`` (digest, doc_id, rid, count), which it holds: their rows are counted, and a
    larger (doc_id, rid) takes the slot's locator over."""

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return held.select(index_columns)
        shard = _shard(held)
        at, member = _members(asked, shard)
        if not member.all():
            raise ValueError("a digest is not in the index")
        doc_ids, rids, counts = (np.frombuffer(shard[name], "<i8").copy() for name in ("doc_ids", "rids", "counts"))
        doc_id, rid, count = (asked[name].to_numpy() for name in ("doc_id", "rid", "count"))
        larger = (doc_id > doc_ids[at]) | ((doc_id == doc_ids[at]) & (rid > rids[at]))
        doc_ids[at[larger]], rids[at[larger]] = doc_id[larger], rid[larger]
        counts[at] += count
        new = shard | {"doc_ids": doc_ids.tobytes(), "rids": rids.tobytes(), "counts": counts.tobytes()}
        return pa.Table.from_pydict({name: pa.array([new[name]], held.schema.field(name).type) for name in index_columns})

    index_columns = index.columns
    asked = repeats.select("digest", "doc_id", "rid", "count").withColumn("shard", shard_of(shards))
    return index.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(run, INDEX)


def entries(index: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_rid, group_size) of every slot."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                numbers = [pa.array(np.frombuffer(shard[name], "<i8")) for name in ("doc_ids", "rids", "counts")]
                digest = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(numbers[0]), [None, pa.py_buffer(shard["digests"])])
                yield pa.RecordBatch.from_arrays([digest.cast(pa.binary()), *numbers], ["digest", "keep_id", "keep_rid", "group_size"])

    return in_tasks(index.select("digests", "doc_ids", "rids", "counts"), run, FOUND)


def keepers(rows: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(digest, keep_id, keep_rid, group_size) of every digest of ``rows`` (rid, doc_id, digest), batch after batch."""
    generations: list[tuple[DataFrame, int]] = []
    for batch in range(batches):
        left = save(winners(rows.where(F.pmod(F.xxhash64("rid"), F.lit(batches)) == batch)), "winners")
        for at, (index, shards) in enumerate(generations):
            marked = save(mark(left, index, shards), "marked")
            generations[at] = (save(absorb(index, marked.where("repeat"), shards), "index"), shards)
            left = marked.where("NOT repeat").drop("repeat")
        shards = shard_count(left)
        generations.append((save(build_index(left, shards), "index"), shards))
    found = entries(generations[0][0])
    for index, _ in generations[1:]:
        found = found.unionByName(entries(index))
    return save(found, "keepers")


def shard_count(distinct: DataFrame) -> int:
    return max(1, -(-distinct.count() // SLOTS))


def assign(rows: DataFrame, index: DataFrame | None = None, shards: int = 1, distinct: DataFrame | None = None) -> DataFrame:
    """(rid, doc_id, digest, keep_id, keep_rid, group_size, repeat) of every row of ``rows``, a saved table;
    ``distinct`` are its ``winners``, where they are known.

    ``repeat`` says that the digest is in the index. Without an index, or for digests that are not in
    it, the rows are grouped among themselves and ``repeat`` is false.
    """
    if index is None:
        index = rows.sparkSession.createDataFrame([], INDEX)
    found = save(probe(winners(rows) if distinct is None else distinct, index, shards), "probed")
    return rows.join(found, "digest").select("rid", "doc_id", "digest", F.nullif("keep_id", F.lit(NO_ID)).alias("keep_id"), "keep_rid", "group_size", "repeat")


def dedup(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text and the number of rows that have it."""
    rows = digests(docs)
    located = rows.join(keepers(rows), "digest")
    return located.select("doc_id", "rid", "digest", F.nullif("keep_id", F.lit(NO_ID)).alias("keep_id"), "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (the filter of a pipeline)."""
    saved = save(with_row_id(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "documents")
    source = saved.select("rid", "doc.doc_id", "doc.text")
    digest = F.unhex(F.sha2(F.encode(lower_az(F.col("text")), "UTF-8"), 256)).alias("digest")
    rows = save(source.select("rid", F.col("doc_id").cast("long").alias("doc_id"), digest), "digests")
    stay = keepers(rows).select(F.col("keep_rid").alias("rid"))
    return saved.join(stay, "rid", "left_semi").select("doc.*")
