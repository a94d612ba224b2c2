"""Operator 10: language identification with interpolated Kneser-Ney character models.

Letters are lower-cased and mapped to 63 classes (a-z, and other letters by code point), every run of
other characters to one boundary, so an n-gram of four symbols is a 24-bit code. Counts per language and
code are gathered over all learning rows by a Spark aggregation; one row per language then holds the
model: for orders 4 to 1, sorted arrays of codes beside counts (raw for order 4, continuation counts
below), sorted arrays of contexts beside totals and follower counts, and the discount. A document gets
the language of the lowest cross-entropy per symbol.

Bounds: a model has at most 2**24 codes per language whatever the corpus, so it is broadcast; texts are
scored in runs of ``RUN_BYTES``. Hot sources or languages do not matter, as counts are summed per batch
before they are shuffled.

Rejection is calibrated on the learning rows that were put right: from their cross-entropies, per
language, comes the level above which a text is not of the language (see ``calibrated``).

Defined results: a text that is null or has no letter is ``und`` with score 0; rows without language or
doc_id are not learned from; ties go to the language that sorts first; without any learning row every
text is ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from stockroom.llm.common import byte_view, in_tasks, per_worker, save, slices, text_array

ORDER, BITS, RUN_BYTES = 4, 6, 1 << 20
CODES = 1 << (ORDER * BITS)
UND = "und"
MODEL = "lang string, " + ", ".join(f"codes{n} binary, counts{n} binary, contexts{n} binary, totals{n} binary, followers{n} binary, discount{n} double" for n in range(1, ORDER + 1))
SCORED = [StructField("lang", StringType()), StructField("entropy", DoubleType()), StructField("second", DoubleType()), StructField("n_symbols", LongType())]


def _classes() -> np.ndarray:
    """The class of every code point: 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        char = chr(cp)
        if char.isalpha():
            low = ord(char.lower()[0])
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return table


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 24-bit code that ends at each symbol of the texts (a binary array), the n + 1 offsets of the
    texts in the codes, and the number of letters of each text."""
    body, at = byte_view(texts)
    points = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
    at = heads[at]
    kind = per_worker("llm letter classes", _classes)[points]
    first = np.zeros(len(kind) + 1, bool)
    first[at] = True
    before = np.concatenate([[0], kind[:-1]]) if len(kind) else kind
    keep = (kind > 0) | ((before > 0) & ~first[: len(kind)])
    kept = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(kind > 0)])
    at, count = kept[at], np.diff(letters[at])
    kind = kind[keep].astype(np.int32)
    place = np.arange(len(kind)) - np.repeat(at[:-1], np.diff(at))
    code = kind.copy()
    for back in range(1, ORDER):
        past = np.zeros_like(kind)
        past[back:] = kind[:-back] if len(kind) > back else 0
        past[place < back] = 0
        code |= past << (BITS * back)
    return code, at, count


def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Room for ``numbered``; a task makes it once and drops it at its end."""
    return np.zeros(CODES, bool), np.zeros(CODES, np.int32)


def numbered(code: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, ascending, and the number of each code among them."""
    seen, number = tables
    seen[code] = True
    distinct = np.flatnonzero(seen)
    seen[distinct] = False
    number[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct, number[code]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, code, count) over all rows of ``docs`` (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = code_tables()
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                code, at, _ = symbols(text_array(part.column("text")))
                langs = part.column("lang").dictionary_encode()
                distinct, number = numbered(code, tables)
                lang = np.repeat(langs.indices.to_numpy(), np.diff(at)).astype(np.int64)
                sums = np.bincount(lang * len(distinct) + number, minlength=len(langs.dictionary) * len(distinct))
                some = np.flatnonzero(sums)
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array(some // len(distinct))), pa.array(distinct[some % len(distinct)]), pa.array(sums[some])], names=["lang", "code", "count"]
                    )

    rows = docs.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return in_tasks(rows, run, "lang string, code long, count long").groupBy("lang", "code").agg(F.sum("count").alias("count"))


def _fit(group: pa.Table) -> pa.Table:
    code, count = group["code"].to_numpy(), group["count"].to_numpy()
    by = np.argsort(code)
    code, count = code[by], count[by]
    out = {"lang": [group["lang"][0].as_py()]}
    for n in range(ORDER, 0, -1):
        context, begin = np.unique(code >> BITS, return_index=True)
        ones, twos = int((count == 1).sum()), int((count == 2).sum())
        out |= {
            f"codes{n}": [code.astype("<i4").tobytes()],
            f"counts{n}": [count.astype("<f4").tobytes()],
            f"contexts{n}": [context.astype("<i4").tobytes()],
            f"totals{n}": [np.add.reduceat(count, begin).astype("<f4").tobytes()],
            f"followers{n}": [np.diff(np.append(begin, len(code))).astype("<f4").tobytes()],
            f"discount{n}": [ones / (ones + 2 * twos) if ones and twos else 0.5],
        }
        # continuation counts of the next lower order: how many symbols a gram is seen to follow
        code, count = np.unique(code & ((1 << (BITS * (n - 1))) - 1), return_counts=True)
    names = [f.split()[0] for f in MODEL.split(", ")]
    return pa.Table.from_pydict({name: out[name] for name in names})


def fit(docs: DataFrame) -> list[dict]:
    """The models of the languages of ``docs`` (text, lang), in the order of their names."""
    models = save(gram_counts(docs), "gram_counts").groupBy("lang").applyInArrow(_fit, MODEL)
    return [row.asDict() for row in models.orderBy("lang").collect()]


def log_probs(model: dict, code: np.ndarray) -> np.ndarray:
    """The log probability of the last symbol of each code, given those before it."""
    p = np.full(len(code), 1.0 / (1 << BITS))
    for n in range(1, ORDER + 1):
        own = code & ((1 << (BITS * n)) - 1)
        read = lambda name, kind="<f4": np.frombuffer(model[f"{name}{n}"], kind)  # noqa: E731, B023
        count = _lookup(read("codes", "<i4"), read("counts"), own)
        total = _lookup(read("contexts", "<i4"), read("totals"), own >> BITS)
        kinds = _lookup(read("contexts", "<i4"), read("followers"), own >> BITS)
        d = model[f"discount{n}"]
        known = total > 0
        total = np.where(known, total, 1)
        p = np.where(known, np.maximum(count - d, 0) / total + d * kinds / total * p, p)
    return np.log(p)


def _lookup(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0).astype(np.float64)


def entropies(docs: DataFrame, models: list[dict], carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` beside, from its ``text``, the best language, its cross-entropy per
    symbol, that of the next language and the number of symbols."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tables = shared.value, code_tables()
        names = np.array([m["lang"] for m in own], object)
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                code, at, letters = symbols(text_array(part.column("text")))
                sizes, n = np.diff(at), part.num_rows
                best, first, second = np.zeros(n, np.int64), np.full(n, np.nan), np.full(n, np.nan)
                some = np.flatnonzero((letters > 0) & bool(own))
                if len(some):
                    distinct, number = numbered(code, tables)
                    sums = np.empty((len(own), len(some)))
                    for k, model in enumerate(own):
                        steps = np.concatenate([[0.0], np.cumsum(log_probs(model, distinct)[number])])
                        sums[k] = -(steps[at[some + 1]] - steps[at[some]]) / sizes[some]
                    rank = np.argsort(sums, axis=0, kind="stable")
                    best[some], first[some] = rank[0], np.take_along_axis(sums, rank[:1], 0)[0]
                    second[some] = np.take_along_axis(sums, rank[1:2], 0)[0] if len(own) > 1 else np.inf
                no = np.isnan(first)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carry), pa.array(names[best] if len(own) else np.full(n, UND, object), pa.string(), mask=no), pa.array(first, mask=no), pa.array(second, mask=no), pa.array(sizes)],
                    names=[*carry, "lang", "entropy", "second", "n_symbols"],
                )

    docs = docs.select(*carry, "text")
    schema = StructType([docs.schema[c] for c in carry] + SCORED)
    return in_tasks(docs, run, schema)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def calibrated(found: DataFrame, learned: Column, label: Column) -> DataFrame:
    """``found`` with ``limit`` and ``score``.

    ``limit`` is the cross-entropy above which a text does not count as its language: the median of the
    learning rows of the language that were put right, plus four times the distance from there to their
    99.9 % quantile (1 at least), and a share of 8 / sqrt(symbols), as short texts scatter. ``score`` is the weight of
    the best language against the next, over at most 50 symbols, times a term that falls from 1 to 0
    around the limit.
    """
    right = found.where(learned & (label == F.col("lang")))
    levels = right.groupBy("lang").agg(F.percentile_approx("entropy", [0.5, 0.999], 10000).alias("q"))
    levels = levels.select("lang", (F.col("q")[0] + F.greatest(4 * (F.col("q")[1] - F.col("q")[0]), F.lit(1.0))).alias("level"))
    limit = F.coalesce("level", F.lit(float("inf"))) + F.lit(8.0) / F.sqrt(F.greatest("n_symbols", F.lit(1)))
    symbols_ = F.least("n_symbols", F.lit(50))
    lead = 1 / (1 + F.exp(-F.least((F.col("second") - F.col("entropy")) * symbols_, F.lit(500.0))))
    fit_ = 1 / (1 + F.exp(F.greatest(F.least((F.col("entropy") - limit) * 10, F.lit(500.0)), F.lit(-500.0))))
    # one row a language, at most as many as the model has
    return found.join(F.broadcast(levels), "lang", "left").withColumn("limit", limit).withColumn("score", F.when(F.col("entropy").isNull(), 0.0).otherwise(lead * fit_))


def scored(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` and the figures of every row of ``docs`` (doc_id, text, label): learns from the rows with a
    label whose crc32(doc_id) mod 4 is not 2."""
    models = fit(docs.where(fold(F.col("doc_id")) != 2).select("text", F.col("label").alias("lang")))
    found = save(entropies(docs, models, [*carry, "doc_id", "label"]), "entropies")
    learned = F.coalesce(fold(F.col("doc_id")) != 2, F.lit(False)) & F.col("label").isNotNull()
    reject = F.col("lang").isNull() | F.coalesce(F.col("entropy") > F.col("limit"), F.lit(False))
    return calibrated(found, learned, F.col("label")).withColumn("reject", reject)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, reject) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("label"))
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return scored(docs, []).select("doc_id", held_out, F.coalesce("lang", F.lit(UND)).alias("lang_pred"), "score", "reject")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is identified, with all their columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(whole).select("doc", F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.text", F.col("doc.lang").alias("label"))
    return scored(rows, ["doc"]).where("not reject").select("doc.*")
