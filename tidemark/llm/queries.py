"""The registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    fingerprints,
    langid,
    licenses,
    lm,
    mixing,
    neardup,
    packing,
    pii,
    quality,
    tokencounts,
    toxicity,
    whitening,
)
from tidemark.llm.common import documents, fold_col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.fit_and_score(documents(spark, sf_dir))


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, sf_dir))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.with_surrogates(docs)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(langid.training_rows(docs))
    return langid.identify(docs, model).select(
        "doc_id", (fold_col("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT u, i, md5(array_to_string(w[i:i + 7], ' ')) AS h
        FROM (SELECT u, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM d)),
starts AS (SELECT u, i, count(*) OVER (PARTITION BY u, h) > 1 AS again FROM win),
places AS (SELECT DISTINCT u, unnest(range(i, i + 8)) AS p FROM starts WHERE again),
rep AS (SELECT u, count(*) AS n FROM places GROUP BY u),
lines AS (SELECT u, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT u, count(*) AS lines, count(*) - count(DISTINCT line) AS n FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY u),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(dup.lines, 0) AS n_lines,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]') OR regexp_matches(x, '[^\x00-\x7F]')))
               AS letter_words,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS upper_words
      FROM d LEFT JOIN rep USING (u) LEFT JOIN dup USING (u)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * letter_words < 7 * n_words
            OR 2 * upper_words > n_words) AS kept
FROM b
"""


@query("op6_quality_cascade", OP6_SQL)
def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cascade(documents(spark, sf_dir), report=(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (fold_col("doc_id", 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "n_clauses")


@query("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size")


OP9_SQL = r"""
WITH base AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k,
         md5(text) AS tie
  FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
      FROM base GROUP BY source),
c AS (SELECT *, [3.0, 1.0, 2.0][(r % 3 + 1)::INT]::DOUBLE AS w, 2 * s AS cap,
             1.5 * sum(s) OVER () AS total FROM s),
f AS (SELECT *, cap / w <= (total - coalesce(sum(cap) OVER (ORDER BY cap / w, r
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
      FROM c),
t AS (SELECT source, s, CASE WHEN capped THEN cap
        ELSE (total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0))
             / sum(w) FILTER (WHERE NOT capped) OVER () * w END AS target FROM f),
p AS (SELECT b.doc_id, b.size, t.s, t.target,
             sum(b.size) OVER (PARTITION BY b.source ORDER BY b.k, b.doc_id, b.tie
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - b.size AS start,
             CASE WHEN t.s > 0 THEN floor(t.target / t.s) ELSE 0 END AS e
      FROM base b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       (e * size + greatest(0, least(size, floor(target - e * s) - start)))::BIGINT AS taken
FROM p
"""


@query("op9_mixing", OP9_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), keep_row=False)


@query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.fit_and_whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(documents(spark, sf_dir))
