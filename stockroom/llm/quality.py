"""Operator 9: a quality classifier as a sparse ensemble of rules over text statistics.

1. ``statistics`` turns each whole text into ``STATS``, some twenty numbers.
2. Boosted regression trees of depth ``DEPTH`` are grown on the learning rows; every path from a root to a
   node is a conjunctive rule ("share of upper case > a and distinct words <= b").
3. A lasso logistic regression gives the rules weights, most of them zero.
4. The rules left are compiled into one Spark column expression over the statistics, which scores all rows.

Learning uses at most ``SAMPLE`` labelled rows, those with the least xxhash64 of doc_id among the labels
whose crc32(doc_id) mod 5 is not 0; only these come to the driver, as numbers. Labels, lang, source and
doc_id are never inputs of a score.

Defined results: a null text counts as empty, whose statistics are zeros; rows without doc_id are scored
and not held out; with no label, or labels of one kind, every score is the share of label 1 (0.5 without
any); of several labels for a doc_id the greatest counts; repeated rows are scored each; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stockroom.llm.common import in_tasks, slices, text_array
from stockroom.llm.words import Words, spaced

SAMPLE, TREES, DEPTH, RATE, LEAST, PENALTY, RUN_BYTES = 20_000, 40, 3, 0.3, 10, 0.001, 2 << 20
STATS = [
    "n_chars", "n_words", "n_lines", "word_length", "word_spread", "upper", "digits", "blanks", "marks", "symbols", "not_ascii",
    "letters", "distinct_words", "distinct_pairs", "same_as_before", "top_word", "line_length", "distinct_lines", "mark_ends", "capitalised",
]


def _kinds() -> np.ndarray:
    """Of each byte: upper, digit, blank, mark, symbol, not ASCII, letter."""
    kinds = np.zeros((7, 256), bool)
    kinds[0, 65:91] = kinds[1, 48:58] = kinds[5, 128:] = True
    kinds[2, [32, *range(9, 14)]] = True
    kinds[3, list(b".,;:!?'\"()-")] = True
    kinds[6, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    kinds[4, 33:127] = True
    kinds[4] &= ~(kinds[1] | kinds[3] | kinds[6])
    return kinds


def text_statistics(texts: pa.Array) -> np.ndarray:
    """n x STATS of the texts of a binary array."""
    kinds = _kinds()
    found = Words(texts, spaced())
    raw = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    n = len(texts)

    def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return sums[at[1:]] - sums[at[:-1]]

    count = per_text((raw & 0xC0) != 0x80, found.cuts)
    size = np.maximum(np.diff(found.cuts), 1)
    out = {"n_chars": count, "n_words": np.diff(found.at).astype(float)}
    words = np.maximum(out["n_words"], 1)
    for name, row in zip(("upper", "digits", "blanks", "marks", "symbols", "not_ascii", "letters"), kinds):
        out[name] = per_text(row[raw], found.cuts) / size
    lens = (found.end - found.start).astype(float)
    out["word_length"] = per_text(lens, found.at) / words
    out["word_spread"] = np.sqrt(np.maximum(per_text(lens**2, found.at) / words - out["word_length"] ** 2, 0))
    last, first = raw[found.end - 1] if len(raw) else raw, raw[found.start] if len(raw) else raw
    out["mark_ends"] = per_text(kinds[3][last] | kinds[4][last], found.at) / words
    out["capitalised"] = per_text(kinds[0][first], found.at) / words
    before = np.concatenate([[np.uint64(0)], found.hash[:-1]]) if n and len(found.hash) else found.hash
    out["same_as_before"] = per_text(found.hash == before, found.at) / words
    pairs = found.hash * np.uint64(0x9E3779B97F4A7C15) + before
    out["distinct_words"], out["distinct_pairs"], out["top_word"] = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, (a, b) in enumerate(zip(found.at, found.at[1:])):
        if b > a:
            times = np.unique(found.hash[a:b], return_counts=True)[1]
            out["distinct_words"][i], out["top_word"][i] = len(times) / (b - a), times.max() / (b - a)
            out["distinct_pairs"][i] = len(np.unique(pairs[a:b])) / (b - a)
    out["n_lines"], out["distinct_lines"] = np.ones(n), np.ones(n)
    for i, text in enumerate(texts.to_pylist()):
        lines = text.split(b"\n")
        out["n_lines"][i], out["distinct_lines"][i] = len(lines), len(set(lines)) / len(lines)
    out["line_length"] = count / out["n_lines"]
    return np.column_stack([out[name] for name in STATS])


def statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` beside the statistics of its ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                values = text_statistics(text_array(part.column("text")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), *(pa.array(v) for v in values.T)], names=[*carry, *STATS])

    docs = docs.select(*carry, "text")
    return in_tasks(docs, run, StructType([docs.schema[c] for c in carry] + [StructField(s, DoubleType()) for s in STATS]))


# --- learning ------------------------------------------------------------------------------------

Rule = frozenset  # of (statistic, above, threshold): above says > threshold, else <=


def grow(x: np.ndarray, residual: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, rule: Rule, depth: int) -> list[tuple[Rule, np.ndarray]]:
    """The paths of one regression tree, each with the learning rows that it holds for."""
    best, total = None, residual[rows].sum()
    for s, at in enumerate(cuts) if depth else ():
        if not len(at):
            continue
        bin_ = np.searchsorted(at, x[rows, s], side="left")
        n = np.cumsum(np.bincount(bin_, minlength=len(at) + 1))[:-1]
        sums = np.cumsum(np.bincount(bin_, residual[rows], minlength=len(at) + 1))[:-1]
        more = len(rows) - n
        gain = np.where((n >= LEAST) & (more >= LEAST), sums**2 / np.maximum(n, 1) + (total - sums) ** 2 / np.maximum(more, 1), -1)
        k = int(gain.argmax())
        if gain[k] > total**2 / len(rows) + 1e-9 and (best is None or gain[k] > best[0]):
            best = (gain[k], s, float(at[k]))
    paths = [(rule, rows)] if rule else []
    if best:
        _, s, threshold = best
        above = x[rows, s] > threshold
        for side, part in ((False, rows[~above]), (True, rows[above])):
            paths += grow(x, residual, cuts, part, rule | {(s, side, threshold)}, depth - 1)
    return paths


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, [(x[:, s] > t) == above for s, above, t in rule])


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The rules of boosted trees, in the order in which they were grown."""
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0.01, 0.99, 64))) for s in range(x.shape[1])]
    logit, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        residual = y - p
        paths = grow(x, residual, cuts, np.arange(len(y)), Rule(), DEPTH)
        if not paths:
            break
        rules.update(dict.fromkeys(rule for rule, _ in paths))
        # a row's step is that of its deepest path; paths come root first
        step = np.zeros(len(y))
        for _, rows in paths:
            step[rows] = residual[rows].sum() / max((p[rows] * (1 - p[rows])).sum(), 1e-3)
        logit = logit + RATE * np.clip(step, -4, 4)
    return list(rules)


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression on 0/1 columns with an L1 penalty, by accelerated proximal gradient steps."""
    n = len(y)
    a = np.column_stack([np.ones(n), a.astype(np.float64)])
    v = np.ones(a.shape[1]) / np.sqrt(a.shape[1])
    for _ in range(30):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / np.linalg.norm(a.T @ (a @ v))
    w, ahead, t = np.zeros(a.shape[1]), np.zeros(a.shape[1]), 1.0
    for _ in range(rounds):
        slope = a.T @ (1 / (1 + np.exp(-np.clip(a @ ahead, -30, 30))) - y) / n
        new = ahead - rate * slope
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t, past = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (past - 1) / t * (new - w), new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[float, Rule]]]:
    """The intercept and the weighted rules of a model."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return float(np.log((share + 1e-6) / (1 - share + 1e-6))), []
    rules = tree_rules(x, y)
    if not rules:
        return float(np.log(y.mean() / (1 - y.mean()))), []
    start, weights = lasso(np.column_stack([holds(r, x) for r in rules]), y, PENALTY)
    return start, [(float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6]


def compiled(model: tuple[float, list[tuple[float, Rule]]]) -> Column:
    """The model as a column expression over the statistics."""
    start, rules = model
    total = F.lit(start)
    for weight, rule in rules:
        tests = [F.col(STATS[s]) > F.lit(t) if above else F.col(STATS[s]) <= F.lit(t) for s, above, t in sorted(rule)]
        total = total + F.when(reduce(Column.__and__, tests), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, list[tuple[float, Rule]]]:
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = rows.where((fold(F.col("doc_id")) != 0) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` pairs of numbers
    chosen = docs.join(F.broadcast(rows), "doc_id").select("quality", "text")
    found = statistics(chosen, ["quality"]).limit(sample).toArrow()
    return fit(np.column_stack([found[s].to_numpy() for s in STATS]), found["quality"].to_numpy().astype(float))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score) of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs, labels, sample)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return statistics(docs, ["doc_id"]).select("doc_id", held_out.alias("held_out"), compiled(model).alias("score"))
