"""Operator 5: token ids as flat binary files with 64-bit document offsets.

Format, below one folder: ``kind=ids`` holds files of unsigned little-endian integers (16 bits when the
vocabulary fits, else 32), the documents one after another in ascending doc_id order, each followed by
id 0; ``kind=index`` holds, for the ids file with the same part number, records of three 64-bit integers:
the offset in ids just behind the document, its doc_id, and 1 if the doc_id is null. An ids file can be
memory-mapped as it is. A file's base (the ids of all files before it) is a prefix sum over file lengths.

Both files come from one job of Spark's text writer, whose rows are the raw bytes and whose line
separator is the two or four zero bytes that close a record, so the writer's commit protocol covers them
and any store that Spark can write to will do. The readers map the files where the store is a file system
that executors share, and read them through Spark elsewhere.

Texts are range-partitioned by doc_id (ties by text, then by place) into tasks of about ``TASK_BYTES``
of text; equal doc_ids may fill several tasks. A worker keeps the ids of about twice ``KNOWN`` pieces.

Defined results: a null text counts as empty and gives id 0 alone; null doc_ids come first; repeated rows
are written each; other columns are ignored; an empty table gives an empty folder and no row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockroom.llm.common import in_tasks, per_worker, scratch, slices, text_array
from stockroom.llm.pieces import distinct_pieces

TASK_BYTES, RUN_BYTES, RUN_PIECES, KNOWN = 16 << 20, 4 << 20, 4096, 300_000
#: Pieces of ASCII or two-byte characters from U+00C0 on, without white space but a blank in front.
PLAIN = re.compile(rb" ?(?:[\x21-\x7e]|[\xc3-\xdf][\x80-\xbf])+")
INDEX = np.dtype([("end", "<u8"), ("doc_id", "<i8"), ("null", "<u8")])
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


class PieceEncoder:
    """Encodes texts with a tokenizers file, each distinct piece once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.size).tobytes() for e in found]

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces. Those that a line end on either side leaves as they are go to the library as the
        lines of one text, which costs far less than a text each; others alone."""
        plain = [p for p in pieces if PLAIN.fullmatch(p)]
        if plain and len(self.line_end) == 1:
            text = b"\n".join(plain).decode() + "\n"
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.size)
            ends = np.flatnonzero(ids == self.line_end[0])
            if len(ends) == len(plain):
                body, cuts = ids.tobytes(), (ends * self.size.itemsize).tolist()
                starts = [0, *(c + self.size.itemsize for c in cuts[:-1])]
                self.known.update(zip(plain, [body[a:b] for a, b in zip(starts, cuts)]))
        rest = [p for p in pieces if p not in self.known]
        if rest:
            self.known.update(zip(rest, self._ids([p.decode() for p in rest])))

    def of(self, distinct: list[bytes]) -> list[bytes]:
        if len(self.known) > KNOWN:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = [p for p in distinct if p not in known]
        if older:  # what is still in use moves on, the rest goes with the next change
            known.update((p, older[p]) for p in new if p in older)
            new = [p for p in new if p not in known]
        for at in range(0, len(new), RUN_PIECES):
            self._learn(new[at : at + RUN_PIECES])
        return [known[p] for p in distinct]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a binary array, as bytes. A text that spells a special token is
        encoded whole, so the token is found as the library finds it."""
        whole = [any(s in t for s in self.special) for t in texts.to_pylist()] if self._spelled(texts) else None
        distinct, number, offsets = distinct_pieces(texts)
        if not len(number):
            return [b""] * len(texts)
        ids = self.of(distinct.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.size.itemsize
        flat, at = np.frombuffer(b"".join(ids), self.size), np.cumsum(sizes) - sizes
        lens = sizes[number]
        ends = np.concatenate([[0], np.cumsum(lens)])
        body = flat[np.repeat(at[number] - ends[:-1], lens) + np.arange(ends[-1])].tobytes()
        cuts = ends[offsets] * self.size.itemsize
        out = [body[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in np.flatnonzero(whole) if whole else ():
            out[i] = self._ids([texts[int(i)].as_py().decode()])[0]
        return out

    def _spelled(self, texts: pa.Array) -> bool:
        import pyarrow.compute as pc

        return any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special)


def encoder(path: str) -> PieceEncoder:
    return per_worker(("llm pieces", path), lambda: PieceEncoder(path))


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids and index files of ``docs`` below ``path``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(64)), F.lit(0))).first()[0]
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("place")]
    placed = (
        docs.withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(max(1, -(-total // TASK_BYTES)), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    kind = id_type(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, end, seq = encoder(tokenizer), 0, 0
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                ids = one.encode(text_array(part.column("text")))
                doc = part.column("doc_id")
                rows = np.zeros(len(ids), INDEX)
                rows["end"] = end + np.cumsum([len(x) // kind.itemsize + 1 for x in ids])
                rows["doc_id"], rows["null"] = doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False)
                # the writer adds the zero bytes that end a record: the document's id 0, the index's top bytes
                index = [r.tobytes()[: -kind.itemsize] for r in rows]
                at = pa.array(np.tile(np.arange(seq, seq + len(ids)), 2))
                yield pa.RecordBatch.from_arrays([pa.array(["ids"] * len(ids) + ["index"] * len(ids)), at, pa.array(ids + index, pa.binary())], ["kind", "seq", "value"])
                end, seq = int(rows["end"][-1]), seq + len(ids)

    rows = in_tasks(placed, run, "kind string, seq long, value binary").sortWithinPartitions("kind", "seq")
    rows.select("kind", F.col("value").cast("string")).write.partitionBy("kind").option("lineSep", "\0" * kind.itemsize).text(path)


def id_type(tokenizer: str) -> np.dtype:
    from tokenizers import Tokenizer

    return np.dtype("<u2") if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else np.dtype("<u4")


def local_path(path: str) -> str:
    """The path of a file that is mounted on every executor."""
    from urllib.parse import unquote, urlparse

    return unquote(urlparse(path).path)


def map_ids(path: str, kind: np.dtype) -> np.ndarray:
    """The ids of one file, memory-mapped."""
    return np.memmap(local_path(path), dtype=kind, mode="r")


def files(spark: SparkSession, path: str, kind: np.dtype) -> DataFrame:
    """(part, path, base, n_ids, index) of every ids file; base counts the ids of all files before it."""
    part = F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("part")
    every = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    ids = every.load(f"{path}/kind=ids").select(part, "path", (F.col("length") / kind.itemsize).cast("long").alias("n_ids"))
    index = every.load(f"{path}/kind=index").select(part, F.col("content").alias("index"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ids.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(index, "part")


def read_tokens(spark: SparkSession, path: str, kind: np.dtype) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    import pyspark.errors

    try:
        found = files(spark, path, kind)
    except pyspark.errors.AnalysisException:  # no document was written, so the kinds have no folder
        return spark.createDataFrame([], READ)
    mapped = re.match(r"file:|/", path) is not None
    if not mapped:
        content = spark.read.format("binaryFile").load(f"{path}/kind=ids").select("path", "content")
        found = found.join(content, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = map_ids(row["path"], kind) if mapped else np.frombuffer(row["content"], kind)
                index = np.frombuffer(row["index"], INDEX)
                ends = index["end"].astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc_id"], mask=index["null"] == 1), pa.array(starts + row["base"]), pa.array(ends - starts), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # a file a task: the rows are few, what they name is large
    return in_tasks(found.repartition(max(1, found.count()), "part"), run, READ)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a fresh folder and read the files back."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path, id_type(tokenizer))
