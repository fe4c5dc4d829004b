"""Registered queries: word vectors, period vectors, encoders (step 4)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from tidemark.functions.vectors import round_vector
from tidemark.operators.embedding import (
    attach_period_mean,
    encode_text,
    hashed_token_counts,
    hashing_encoder,
    mean_word_vector,
    period_mean_vector,
    period_vector_sum,
    period_word_vector_sum,
)
from tidemark.operators.encoder import contextual_encoder, random_weights
from tidemark.operators.periods import PERIOD_KEYS, period_volume
from tidemark.operators.text import with_tokens
from tidemark.plans import sqlfrag as S
from tidemark.plans.registry import query
from tidemark.plans.resources import corpus_word_vectors, embedding_dim
from tidemark.sources.adapters import document_posts, read_table, text_table

V = 4  # decimals of vector elements compared against the oracle


@query("mean_word_vector", sql=f"""
WITH {S.WORD_VECTORS},
toks AS (SELECT doc_id AS post_id, unnest({S.drop_stop(S.tokens(S.clean('text')))}) AS token
         FROM documents),
pv AS ({S.post_vec_rows('toks')}),
vecs AS (SELECT post_id, list(x ORDER BY i) AS vec FROM pv GROUP BY post_id)
SELECT d.doc_id, {S.round_list(f"coalesce(v.vec, {S.zeros()})")} AS vec
FROM documents d LEFT JOIN vecs v ON d.doc_id = v.post_id""")
def q_mean_word_vector(spark, sf_dir):
    docs = with_tokens(text_table(spark, sf_dir, "documents", "doc_id"))
    out = mean_word_vector(docs, corpus_word_vectors(spark, sf_dir), embedding_dim(spark, sf_dir),
                           key_col="doc_id")
    return out.select("doc_id", round_vector("vec", V).alias("vec"))


@query("period_mean_vector", sql=f"""
SELECT label, n_posts, {S.round_list('list(x ORDER BY i)')} AS vec
FROM (SELECT label, i, avg(x) AS x, count(*) AS n_posts FROM (
        SELECT label, unnest(range(len(embedding))) AS i,
               unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
      GROUP BY ALL)
GROUP BY label, n_posts""")
def q_period_mean_vector(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    out = period_mean_vector(emb, ["label"], "embedding")
    return out.select("label", "n_posts", round_vector("vec", V).alias("vec"))


@query("period_vector_from_words", sql=f"""
WITH {S.WORD_VECTORS}, {S.DOC_POSTS},
toks AS (SELECT post_id, unnest(tokens) AS token FROM posts),
pv AS ({S.post_vec_rows('toks')}),
per AS (SELECT match_id, period_id, id, count(*) AS n_posts FROM posts GROUP BY ALL),
sums AS (
  SELECT match_id, period_id, id, list(s ORDER BY i) AS ssum FROM (
    SELECT p.match_id, p.period_id, p.id, v.i, sum(v.x) AS s
    FROM pv v JOIN posts p ON v.post_id = p.post_id GROUP BY ALL)
  GROUP BY ALL)
SELECT per.match_id, per.period_id, per.id, per.n_posts,
       {S.round_list(f"coalesce(list_transform(sums.ssum, lambda x: x / per.n_posts), {S.zeros()})")} AS vec
FROM per LEFT JOIN sums USING (match_id, period_id, id)""")
def q_period_vector_from_words(spark, sf_dir):
    keys = list(PERIOD_KEYS)
    posts = with_tokens(document_posts(spark, sf_dir, labelled=False))
    sums = period_word_vector_sum(posts, corpus_word_vectors(spark, sf_dir), keys)
    out = attach_period_mean(period_volume(posts), sums, keys, embedding_dim(spark, sf_dir))
    return out.select(*keys, "n_posts", round_vector("vec", V).alias("vec"))


@query("encode_text_batch", note="rows-only: pluggable batch encoder via predict_batch_udf")
def q_encode_text_batch(spark, sf_dir):
    keys = list(PERIOD_KEYS)
    posts = with_tokens(document_posts(spark, sf_dir, labelled=False)).withColumn(
        "clean", F.concat_ws(" ", "tokens"))
    enc = encode_text(posts, "clean", 64, make_encoder=hashing_encoder(64), batch_size=128)
    sums = period_vector_sum(enc.select(*keys, "vec"), keys)
    out = attach_period_mean(period_volume(posts), sums, keys, 64)
    return out.select(*keys, "n_posts", round_vector("vec", V).alias("vec"))


@query("encode_text_contextual", note="rows-only: self-attention over subwords of a public vocabulary, cut at 128, weights "
       "from a file (seeded: trained ones are an input); tests compare it with a plain loop")
def q_encode_text_contextual(spark, sf_dir):
    import public_tokenizers

    keys, dim = list(PERIOD_KEYS), 32
    folder = tempfile.mkdtemp(prefix="tidemark-weights-")
    # Spark's file distribution goes by names: each call has its own.
    weights = random_weights(os.path.join(folder, f"{os.path.basename(folder)}.npz"), 49_408, dim)
    encoder = contextual_encoder(spark, weights, public_tokenizers.path("word_bpe_49k.json"), 49_406, 49_407)
    posts = document_posts(spark, sf_dir, labelled=False)
    enc = encode_text(posts, "text", dim, make_encoder=encoder, batch_size=512)
    out = attach_period_mean(period_volume(posts), period_vector_sum(enc.select(*keys, "vec"), keys), keys, dim)
    return out.select(*keys, "n_posts", round_vector("vec", 3).alias("vec"))


@query("encode_text_hashing", note="rows-only: JVM HashingTF encoder")
def q_encode_text_hashing(spark, sf_dir):
    keys = list(PERIOD_KEYS)
    posts = with_tokens(document_posts(spark, sf_dir, labelled=False))
    enc = encode_text(posts, "text", 256, tokens_col="tokens")
    sums = period_vector_sum(enc.select(*keys, "vec"), keys)
    out = attach_period_mean(period_volume(posts), sums, keys, 256)
    return out.select(*keys, "n_posts", round_vector("vec", V).alias("vec"))


@query("hashed_token_sums", sql=f"""
WITH {S.DOC_POSTS},
toks AS (SELECT match_id, period_id, id, unnest(tokens) AS token FROM posts)
SELECT match_id, period_id, id, CAST(('0x' || substr(md5(token), 1, 8))::BIGINT % 256 AS INTEGER) AS bucket,
       count(*) AS n
FROM toks GROUP BY ALL""")
def q_hashed_token_sums(spark, sf_dir):
    posts = with_tokens(document_posts(spark, sf_dir, labelled=False))
    return hashed_token_counts(posts, list(PERIOD_KEYS), 256)
