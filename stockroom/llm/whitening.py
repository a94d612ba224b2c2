"""Operator 11: whitening of embedding vectors by a covariance from variances of sums (polarisation).

Entries become whole numbers, ``x = floor(64 * c) + 1000000``. One aggregation gives the number of vectors ``n``
and the sums ``S`` of each dimension; the centred entries ``v = n * x - S`` are whole numbers too. A second
one sums ``v_i ** 2`` for every dimension and ``(v_i + v_j) ** 2`` for every pair of them. As

    2 * cov(i, j) = var(i + j) - var(i) - var(j),

differences of these sums are all cross-covariances, exact up to the one division by ``2 * n ** 3`` that makes
them doubles. The matrix goes to ``eigh``; rows are then projected on its leading eigenvectors. A last aggregation
over the whitened rows, which are written first, measures how far their covariance is from the identity.

Squares are summed exactly: 64-bit numbers are cut into limbs of 25 bits, whose products cannot overflow in a block of
rows; entries or sums beyond 62 bits are handled as Python integers. Sums of tasks are DECIMAL(38, 0).

Scale: each pass reads the vectors once and sends d or d * (d + 1) / 2 rows a task to the shuffle; the driver gets as
many, whatever the number of vectors. The model (d * k doubles) goes to the tasks.

Defined results: a vector that is null, empty or holds a null or non-finite entry, or one whose ``x`` is not a long, is
dropped; so is a vector of another length than most of the others (ties: the longer one), as it has no value for
some dimension. Repeated vectors and ids count as often as they stand there. Without any vector left there are no
rows. In a direction without variance (fewer vectors than dimensions, equal vectors) ``whitened`` is 0, and
``identity_error`` is taken over the other directions. The sign of a component, and the choice of axes for equal
eigenvalues, are those of ``eigh``, the same for all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import in_tasks, save

SCALE, OFFSET = 64, 1_000_000
#: Components that are returned.
COMPONENTS = 32
#: Rows that are squared at once, and bits of a limb: 2 * 25 + 11 bits fit a long.
BLOCK, LIMB = 2048, 25
#: Above this, numbers are handled as Python integers.
SAFE = 1 << 61

_EXACT = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Model:
    """n vectors, their sums and least entries a dimension, and the eigenvalues (falling) and unit eigenvectors
    (columns) of their covariance."""

    n: int
    sums: list[int]
    least: list[int]
    spread: int
    values: np.ndarray
    vectors: np.ndarray

    @property
    def trace(self) -> float:
        return float(self.values.sum())

    def rank(self) -> int:
        """Directions that have variance beyond rounding."""
        floor = max(float(self.values[0]), 0.0) * len(self.values) * np.finfo(float).eps * 8 if len(self.values) else 0.0
        return int((self.values > floor).sum())


def whole(entry: Column) -> Column:
    """Whether an entry is a finite number whose ``x`` is a long."""
    scaled = F.abs(entry.cast("double")) * SCALE
    return F.coalesce(scaled < F.lit(2.0**63 - 2.0**22), F.lit(False))  # false for NaN, which is above all numbers


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector has a whole number in every dimension (see the module's defined results)."""
    whole_rows = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, whole))
    size = F.size(column)
    common = whole_rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return whole_rows.where(size == (common["d"] if common else 0))


def entries(column: pa.Array) -> np.ndarray:
    """A column of vectors of one length as a matrix of their ``x``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * SCALE).reshape(len(column), -1)
    if np.abs(x).max(initial=0) < SAFE:
        return x.astype(np.int64) + OFFSET
    return np.frompyfunc(int, 1, 1)(x) + OFFSET


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield entries(batch.column(column).slice(start, BLOCK))


def centred(x: np.ndarray, n: int, sums: list[int], least: list[int], spread: int) -> np.ndarray:
    """``n * x - S``, exact: 64-bit where twice that fits, Python integers elsewhere."""
    narrow = x.dtype == np.int64 and 2 * n * (spread + 1) < SAFE and max(map(abs, least), default=0) < SAFE
    kind = np.int64 if narrow else object
    low = np.array(least, dtype=kind)
    return n * (x.astype(kind) - low) - np.array([s - n * m for s, m in zip(sums, least, strict=True)], dtype=kind)


def square_sums(s: np.ndarray) -> np.ndarray:
    """The exact sum of squares of every column, as Python integers (at most ``BLOCK`` rows)."""
    if s.dtype == object:
        return (s * s).sum(axis=0)
    limbs, rest = [], s
    bits = int(np.abs(s).max(initial=0)).bit_length()
    while bits > LIMB:
        limbs.append(rest & ((1 << LIMB) - 1))
        rest = rest >> LIMB
        bits -= LIMB
    limbs.append(rest)
    total = np.zeros(s.shape[1], object)
    for a, one in enumerate(limbs):
        for b in range(a, len(limbs)):
            part = np.einsum("ij,ij->j", one, limbs[b]).astype(object)
            total = total + part * ((1 if a == b else 2) << (LIMB * (a + b)))
    return total


def _rows(names: dict[str, pa.DataType], columns: list) -> pa.RecordBatch:
    arrays = [pa.array([Decimal(int(v)) for v in c] if kind == _EXACT else c, kind) for c, kind in zip(columns, names.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def first_sums(vectors: DataFrame, column: str) -> DataFrame:
    """(i, n, sum, least, most) of every dimension."""
    names = {"i": pa.int32(), "n": pa.int64(), "sum": _EXACT, "least": _EXACT, "most": _EXACT}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, None, None, None
        for x in _batches(batches, column):
            x = x.astype(object) if x.dtype != object and np.abs(x).max(initial=0) > 1 << 50 else x
            own = x.sum(axis=0).astype(object), x.min(axis=0).astype(object), x.max(axis=0).astype(object)
            total, low, high = own if total is None else (total + own[0], np.minimum(low, own[1]), np.maximum(high, own[2]))
            n += len(x)
        if n:
            yield _rows(names, [range(len(total)), [n] * len(total), total, low, high])

    exact = "decimal(38,0)"
    parts = in_tasks(vectors.select(column), run, f"i int, n bigint, sum {exact}, least {exact}, most {exact}")
    return parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("sum").cast(exact).alias("sum"), F.min("least").alias("least"), F.max("most").alias("most"))


def second_sums(vectors: DataFrame, column: str, n: int, sums: list[int], least: list[int], spread: int) -> DataFrame:
    """(i, j, squares) for i <= j: the sum of ``v_i ** 2`` where i = j, else of ``(v_i + v_j) ** 2``."""
    names = {"i": pa.int32(), "j": pa.int32(), "squares": _EXACT}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[np.ndarray] = []
        for x in _batches(batches, column):
            v = centred(x, n, sums, least, spread)
            own = [np.concatenate([square_sums(v[:, i : i + 1]), square_sums(v[:, i : i + 1] + v[:, i + 1 :])]) for i in range(v.shape[1])]
            totals = [a + b for a, b in zip(totals, own, strict=True)] if totals else own
        for i, row in enumerate(totals):
            yield _rows(names, [[i] * len(row), range(i, i + len(row)), row])

    parts = in_tasks(vectors.select(column), run, "i int, j int, squares decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("squares").cast("decimal(38,0)").alias("squares"))


def fit(vectors: DataFrame, column: str = "embedding") -> Model | None:
    """The model of all rows of ``vectors``, which are ``usable``; None without any."""
    rows = sorted(first_sums(vectors, column).collect(), key=lambda r: r["i"])
    if not rows:
        return None
    n, sums, least = rows[0]["n"], [int(r["sum"]) for r in rows], [int(r["least"]) for r in rows]
    spread = max(int(r["most"]) - int(r["least"]) for r in rows)
    squares = {(r["i"], r["j"]): int(r["squares"]) for r in second_sums(vectors, column, n, sums, least, spread).collect()}
    d = len(sums)
    covariance = np.empty((d, d))
    for (i, j), q in squares.items():
        # Python divides whole numbers with one rounding
        both = 2 * q if i == j else q - squares[i, i] - squares[j, j]
        covariance[i, j] = covariance[j, i] = both / (2 * n**3)
    values, directions = np.linalg.eigh(covariance)
    return Model(n, sums, least, spread, values[::-1].copy(), directions[:, ::-1].copy())


def project(vectors: DataFrame, model: Model, components: int = COMPONENTS, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, deviation DECIMAL(38, 0), whitened array<double>) of every row of ``vectors``."""
    rank, k = model.rank(), min(components, len(model.sums))
    scale = np.zeros(k)
    scale[: min(k, rank)] = 1 / np.sqrt(model.values[: min(k, rank)])
    axes = model.vectors[:, :k] * scale
    n, sums, least, spread = model.n, model.sums, model.least, model.spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                v = centred(entries(part.column(column)), n, sums, least, spread)
                # the rows of a matrix are the columns of its transpose, in blocks for the limbs
                own = sum(square_sums(v.T[i : i + BLOCK]) for i in range(0, v.shape[1], BLOCK))
                out = (v / n).astype(np.float64) @ axes
                white = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), k).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array([Decimal(int(x)) for x in own], _EXACT), white], [key, "deviation", "whitened"])

    kind = vectors.schema[key].dataType.simpleString()
    return in_tasks(vectors.select(key, column), run, f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of the first ``components`` whitened columns minus the identity."""
    k = components
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[:, :k]
                n, sums, products = n + len(w), sums + w.sum(axis=0), products + w.T @ w
        if n:
            cells = np.concatenate([[n], sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], ["cell", "value"])

    parts = in_tasks(projected.select("whitened"), run, "cell int, value double")
    found = np.array([r["value"] for r in sorted(parts.groupBy("cell").agg(F.sum("value").alias("value")).collect(), key=lambda r: r["cell"])])
    mean = found[1 : 1 + k] / found[0]
    covariance = found[1 + k :].reshape(k, k) / found[0] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    rows = usable(vectors.select(key, column), column)
    model = fit(rows, column)
    if model is None:
        kind = vectors.schema[key].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"`{key}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        )
    k = min(components, len(model.sums))
    projected = save(project(rows, model, k, column, key), "whitened")
    error = identity_error(projected, min(k, model.rank()))
    share = [max(float(e), 0.0) / model.trace if model.trace > 0 else 0.0 for e in model.values[:k]]
    long = projected.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        key,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*map(F.lit, share)), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
