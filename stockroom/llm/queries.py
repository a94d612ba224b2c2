"""The registered queries of this package, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm import bpe, decontam, exact_dedup, langid, line_dedup, near_dedup, periodic, pii, quality, suffix_dedup, token_files, url_tree, whitening
from stockroom.llm.common import table

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), MULTI_RANKS, digest=True)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), BPE_JSON)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, share=0.85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted("doc_id", "text").alias("text"))
    line = "concat_ws(',', r.start, r.length, r.period)"
    best = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    found = periodic.collapse(docs).withColumn("best", F.expr(best))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join(transform(runs, r -> concat({line}, '\n')), '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(key: str, text: str) -> Column:
    """The texts of the query: in a tenth of the documents, by the checksum of the id, the words from one place
    on repeat the first few of them."""
    words = rf"filter(split({text}, '[\\x20\\x09-\\x0D]+'), w -> w != '')"
    h = f"crc32(CAST({key} AS STRING))"
    repeated = f"""
    transform(array(struct({words} AS w, {h} DIV 10 AS g)), s -> transform(
      array(struct(s.w AS w, s.g AS g, s.g % size(s.w) AS a)), s -> transform(
        array(struct(s.w AS w, s.a AS a, 1 + (size(s.w) - s.a) DIV (3 + s.g % 8) AS p)), s ->
          array_join(transform(s.w, (w, i) -> if(i < s.a, w, s.w[CAST(s.a + (i - s.a) % s.p AS INT)])), ' '))))[0][0][0]"""
    return F.expr(f"CASE WHEN {h} % 10 = 0 AND size({words}) > 0 THEN {repeated} ELSE {text} END")


RULES = (
    url_tree.Rule("allow", "org", "/"),
    url_tree.Rule("block", "example.org", "/es/"),
    url_tree.Rule("block", "example.org", "/en/1"),
    url_tree.Rule("allow", "com", "/fr/"),
    url_tree.Rule("block", "com", "/de/"),
)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judge(table(spark, sf_dir, "pages"), RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_pii": op2_pii,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_files": op5_token_files,
    "op6_decontamination": op6_decontamination,
    "op7_near_dedup": op7_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_url_filters": op13_url_filters,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
best AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM texts JOIN best USING (body)
""",
    "op8_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, u.n AS n, u.line AS line,
         translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents, LATERAL (
    SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) AS n) u),
often AS (
  SELECT key, max(doc_id) AS keep_id FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.n, l.line, o.key IS NOT NULL AND l.doc_id <> o.keep_id AS gone
  FROM lines l LEFT JOIN often o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
