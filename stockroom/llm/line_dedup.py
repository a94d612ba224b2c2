"""Operator 8: line deduplication with levelled sorted runs of line hashes.

A store of lines keeps *runs*: tables with, for each line, the number of documents that hold it and the largest of them. A
line is in one run only. Runs are bucketed by line hash and sorted within buckets, so joining one needs
neither a shuffle nor a sort of it. A new batch is summed up per line, then merge-joined with the runs: a run
counts the batch's documents at the lines that it holds, and what an anti-join with all runs leaves, the lines that are new,
forms a run of its own. When a level has ``FANOUT`` runs they are compacted into one run of the next level, so a store of n
batches has about FANOUT * log(n) runs.

Deduplication adds the documents batch by batch, then reads the merged runs: the lines that enough
documents hold are dropped everywhere except in the largest doc_id that holds them.

Skew: a line that a third of all documents hold is summed up per task before each shuffle; in the join of
(line, document) rows with the dropped lines Spark splits the hot line's rows. A document's lines never
leave its row; only their 128-bit hashes are shuffled.

Defined results: a null or empty text is one empty line; rows with the same doc_id and text are one
document and get the same result, other rows are documents of their own, and a line stays in all rows of
the largest doc_id; a null doc_id counts as smallest; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm.common import lower_az, save, scratch
from stockroom.sources.bucketed import forget, save_bucketed

#: Fixed by the rule: what is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
FANOUT, BATCHES, NO_ID = 3, 4, -(1 << 63)
MIN_CHARS, MIN_DOCS = 40, 5
CLEANED = "doc_id long, n_lines long, n_dropped long, kept string"


class LineRuns:
    """Levelled sorted runs of (line, n_docs, keep); keep is the largest (did, body) that holds the line. No two
    runs have a line in common."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[list[DataFrame]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = scratch(spark, "runs")
        self.written = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def merged(self) -> DataFrame:
        """All runs as one: a row per line."""
        return _union(self.runs())

    def add(self, batch: DataFrame) -> DataFrame:
        """Add the lines of ``batch`` (line, did, body) and return those that no earlier batch had."""
        one = F.struct("did", "body").alias("keep")
        lines = self._write(summed(batch.select("line", F.lit(1).cast("long").alias("n_docs"), one)))
        fresh = self._write(self._new(lines)) if self.runs() else lines
        for level in self.levels:
            level[:] = [self._write(self._counted(run, lines)) for run in level]
        self._push(0, fresh)
        return fresh

    def _new(self, lines: DataFrame) -> DataFrame:
        """``lines`` that no run has: a merge-anti-join of sorted buckets with each."""
        for run in self.runs():
            lines = lines.join(run.select("line").hint("merge"), "line", "left_anti")
        return lines

    def _counted(self, run: DataFrame, lines: DataFrame) -> DataFrame:
        """``run`` with the documents of ``lines`` at the lines that it holds."""
        more = lines.select("line", F.col("n_docs").alias("more"), F.col("keep").alias("other")).hint("merge")
        n_docs = F.col("n_docs") + F.coalesce("more", F.lit(0).cast("long"))
        return run.join(more, "line", "left").select("line", n_docs.alias("n_docs"), F.greatest("keep", "other").alias("keep"))

    def _write(self, run: DataFrame) -> DataFrame:
        self.written += 1
        return save_bucketed(run, f"{self.folder}/run{self.written}", ["line"], ["line"], self.buckets)

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FANOUT:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._write(_union(full)))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("line").agg(F.sum("n_docs").alias("n_docs"), F.max("keep").alias("keep"))


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the document's key: did (doc_id, null smallest) and a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(NO_ID)).alias("did"), F.xxhash64(text, F.lit(1)).alias("body"))


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(line, did, body): the hash of each distinct key of a document, of at least ``min_chars`` code points."""
    keys = F.transform(F.split("text", "\n", -1), lambda x: lower_az(F.btrim(x, F.lit(BLANKS))))
    long = F.array_distinct(F.filter(keys, lambda x: F.char_length(x) >= min_chars))
    return docs.select("did", "body", F.explode(long).alias("key")).select(F.unhex(F.md5(F.encode("key", "UTF-8"))).alias("line"), "did", "body")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, dropped, kept = [], [], []
        for text, drop in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist()):
            if not drop:
                lines.append(text.count("\n") + 1), dropped.append(0), kept.append(text)
                continue
            drop, parts = set(drop), text.split("\n")
            stay = [x for x in parts if hashlib.md5(x.strip(BLANKS).encode().lower()).digest() not in drop]
            lines.append(len(parts)), dropped.append(len(parts) - len(stay)), kept.append("\n".join(stay))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every row of ``docs``; ``kept`` is the text that is left."""
    rows = documents(docs)
    # rows of one document are one holder of its lines
    lines = line_keys(rows, min_chars).withColumn("batch", F.pmod(F.xxhash64("did", "body", F.lit(2)), F.lit(batches)))
    lines = save(lines, "line_hashes")
    store = LineRuns(docs.sparkSession)
    for batch in range(batches):
        store.add(lines.where(F.col("batch") == batch).drop("batch").distinct())
    often = store.merged().where(F.col("n_docs") >= min_docs).select("line", F.col("keep.did").alias("keep_did"))
    often = save(often, "often")
    forget(docs.sparkSession, store.folder)
    # a line's hash in one document once more: repeated rows of a document collapse in the set
    drops = (
        lines.join(often, "line")
        .where(F.col("did") != F.col("keep_did"))
        .groupBy("did", "body")
        .agg(F.collect_set("line").alias("drop"))
    )
    return rows.join(drops, ["did", "body"], "left").select("doc_id", "text", "drop").mapInArrow(_rebuild, CLEANED)
