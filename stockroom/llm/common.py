"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import sys
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import ensure_checkpoint_dir, is_local, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text bytes that one step inside a Python worker handles at once (a longer text is handled alone).
CHUNK_BYTES = 8 << 20


def lower_az(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``.

    Only a local master may lack that setting (tests); it then gets a folder of its own.
    """
    if is_local(spark) and not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="stockroom-"))
    return scratch_path(spark, name)


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and return the table read from it.

    This cuts the lineage: what follows re-reads the files if an executor is lost, and values that
    depend on how rows were dealt out (row ids) are fixed once written.
    """
    path = scratch(df.sparkSession, name)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_tasks(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, whose tasks give the memory they used back to the system.

    Python workers live on between tasks and stages; what their allocators keep would add up in executors.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return df.mapInArrow(tidy, schema)


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def per_worker(key: object, build: Callable[[], object]) -> object:
    """``build()`` once for each Python worker process, kept between its tasks."""
    store = vars(sys).setdefault("_stockroom_llm_store", {})
    if key not in store:
        store[key] = build()
    return store[key]


def text_array(column: pa.Array) -> pa.Array:
    """A string column as ``binary`` with 32- or 64-bit offsets, nulls as empty."""
    if pa.types.is_string_view(column.type) or pa.types.is_binary_view(column.type):
        column = column.cast(pa.large_string())
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    column = column.cast(kind)
    return column.fill_null(b"") if column.null_count else column


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls, joined, and the n + 1 offsets into them."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return body, at - at[0] if len(at) else np.zeros(1, np.int64)


def slices(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have at most ``most`` bytes together (one row at least)."""
    if not batch.num_rows:
        return
    sizes = np.diff(byte_view(text_array(batch.column(text)))[1])
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def with_row_id(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` of ``docs`` beside ``rid``, a number of the row that is fixed only once it is saved."""
    return docs.select(F.monotonically_increasing_id().alias("rid"), *columns)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class RollingHash:
    """Polynomial hashes, modulo 2**64, of any stretches of a sequence of numbers.

    A stretch's hash depends on its content alone, not on its place. Different content of the same
    hash is possible, so results that depend on equality are confirmed on the content itself or use
    two of these with different ``base``.
    """

    def __init__(self, values: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        n = len(values)
        base |= 1
        inverse = pow(base, -1, 1 << 64)
        self.up = _powers(base, n + 1)
        terms = values.astype(np.uint64)
        terms *= _powers(inverse, n + 1)[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.up[starts])


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the longest n so far."""
    store = vars(sys).setdefault("_stockroom_llm_powers", {})
    have = store.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            more = min(done, size - done)
            have[done : done + more] = have[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        store[base] = have
    return have[:n]
