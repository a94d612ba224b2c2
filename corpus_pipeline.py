"""A corpus pipeline: each stage reads the rows that the one before it kept.

Every stage takes (spark, docs, sf_dir). All but the last return rows of ``docs`` with its columns; the
last returns a document's token ids, as little-endian unsigned 32-bit integers, and the text decoded from
them.

In every stage: an empty ``docs`` gives an empty result; repeated rows are rows of their own until exact dedup; a null in
``lang``, ``source`` or ``n_chars`` changes nothing; columns that ``docs`` has beyond those of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockroom.llm import bpe, decontam, exact_dedup, langid, near_dedup
from stockroom.llm.common import save, table
from stockroom.llm.queries import MULTI_RANKS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without a letter (null and empty texts too), or unlike any
    language, go. Equal texts get one answer. Without a learnt language (all ``lang`` null) all go."""
    return langid.keep_identified(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased; null is empty), the row with the largest doc_id (null is smallest); among rows
    with the same doc_id and text, one."""
    return exact_dedup.keep_first(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over five-word shingles, that with the
    smallest doc_id. Texts without words are linked with nothing and stay."""
    return near_dedup.keep_one(docs, words=5, share=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, null and empty texts among them. Without items all stay."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document that is left; a null text counts as empty and has no ids."""
    return bpe.encoded(docs, MULTI_RANKS)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: No SQL: learned models, components and alignments; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
