"""Post and period vectors (J1-J3, A5, X11, X12, U3) and text encoders.

The mean word vector of a post is the mean over its tokens (with
multiplicity) that have a vector; a post with none gets the zero vector.
Period vectors are the mean of post vectors. To avoid joining vectors back
onto posts, the period table is built from a per-period *sum* of post
vectors divided by the period's post count (posts without any known word
add zeros, exactly as the zero vector does).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import token_bucket
from tidemark.functions.text import token_rows
from tidemark.functions.vectors import zero_vector
from tidemark.operators.lookup import DEFAULT_BROADCAST_BYTES, bounded_bytes
from tidemark.sources.io import materialize


def _element_sums(dim: int, element) -> list[Column]:
    """A sum for each place of a vector: plain columns, so that tasks add up rows before any are sent."""
    return [F.sum(element(i)).alias(f"__s{i}") for i in range(dim)]


def _array_of(dim: int, element) -> Column:
    return F.array(*[element(F.col(f"__s{i}")) for i in range(dim)]).cast("array<double>")


def _vector_length(vectors: DataFrame) -> int:
    """The one length of the vectors that are not null (0 if there is none). Entries must not be null."""
    size = F.when(F.col("vec").isNotNull(), F.size("vec"))
    row = vectors.agg(F.min(size).alias("low"), F.max(size).alias("high"),
                      F.max(F.exists("vec", lambda e: e.isNull())).alias("gaps")).first()
    if row.low != row.high:
        raise ValueError(f"vectors of lengths {row.low} to {row.high}")
    if row.gaps:
        raise ValueError("vectors with null entries")
    return row.high or 0


def _word_hits(df: DataFrame, vectors: DataFrame, keys: Sequence[str], tokens_col: str, limit: int) -> DataFrame:
    """``keys..., word, vec, __d`` for each token that has a vector (``__d``: rows of ``vectors`` with this word).

    Vectors are broadcast if their counted bytes are within ``limit``. Else the tokens are written once, the words
    that occur most often, as many as fit ``limit``, are broadcast, and only the tokens of all other words meet
    their vectors in a sort-merge join.
    """
    vectors = vectors.select("word", "vec").where(F.col("word").isNotNull() & F.col("vec").isNotNull())
    vectors = vectors.join(vectors.groupBy("word").agg(F.count(F.lit(1)).alias("__d")), "word")
    size = bounded_bytes(vectors, 1 << 62)
    if size <= limit:
        return token_rows(df, keys, tokens_col, "word").join(F.broadcast(vectors), "word")
    tokens = token_rows(materialize(df.select(*keys, F.col(tokens_col).alias("tokens")), "word-tokens"), keys, out="word")
    found = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vectors.groupBy("word").agg(
        F.count(F.lit(1)).alias("rows")).hint("shuffle_merge"), "word")
    found = materialize(found, "word-frequencies")
    room, least = limit * vectors.count() // size, None
    # Different numbers of occurrences are few: their sum is at most the number of tokens.
    for r in found.groupBy("n").agg(F.sum("rows").alias("rows")).orderBy(F.desc("n")).collect():
        room -= r.rows
        if room < 0:
            break
        least = r.n
    often = found.where(F.col("n") >= least if least is not None else F.lit(False)).select("word")
    hot = vectors.join(F.broadcast(often), "word")
    rest = tokens.join(F.broadcast(often), "word", "left_anti").join(vectors.hint("shuffle_merge"), "word")
    return tokens.join(F.broadcast(hot), "word").unionByName(rest)


def _post_sums(df: DataFrame, vectors: DataFrame, keys: Sequence[str], tokens_col: str,
               limit: int) -> tuple[DataFrame, int]:
    """Per post with a known token the sums ``__s0...`` of its tokens' vectors, ``__rows`` and ``__weight`` (known tokens,
    unless words repeat in ``vectors``); and the vectors' length.

    A post's tokens lie in one row, so a task adds them up and sends one row for each post: no vector is shuffled for
    a token or a word.
    """
    dim = _vector_length(vectors)
    hit = _word_hits(df, vectors, keys, tokens_col, limit)
    return hit.groupBy(*keys).agg(
        *_element_sums(dim, lambda i: F.col("__d") * F.get("vec", F.lit(i)).cast("double")),
        F.count(F.lit(1)).alias("__rows"), F.sum("__d").alias("__weight")), dim


def post_vectors(df: DataFrame, vectors: DataFrame, keys: Sequence[str],
                 tokens_col: str = "tokens", out_col: str = "vec", limit: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``keys..., out_col`` for posts with at least one known token.

    ``vectors`` is ``word, vec array<float|double>`` with unique words; a word
    whose vector is null has none. At most ``limit`` bytes of them are broadcast (see ``_word_hits``).
    """
    keys = list(keys)
    sums, dim = _post_sums(df, vectors, keys, tokens_col, limit)
    return sums.select(*keys, _array_of(dim, lambda s: s / F.col("__weight")).alias(out_col))


def period_word_vector_sum(df: DataFrame, vectors: DataFrame, keys: Sequence[str],
                           post_key: str = "post_id", tokens_col: str = "tokens",
                           out_col: str = "vec_sum", limit: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Per period the sum of its posts' mean word vectors.

    A post's tokens are added up first, so a post and then a period and task
    send one vector each, whatever the number of words.
    """
    keys = list(keys)
    posts, dim = _post_sums(df, vectors, [*keys, post_key], tokens_col, limit)
    means = posts.select(*keys, _array_of(dim, lambda s: s / F.col("__rows")).alias("vec"))
    return period_vector_sum(means, keys, out_col=out_col)


def mean_word_vector(df: DataFrame, vectors: DataFrame, dim: int, key_col: str = "post_id",
                     tokens_col: str = "tokens", out_col: str = "vec") -> DataFrame:
    """Every row of ``df`` with its mean word vector (zero vector if none)."""
    pv = post_vectors(df, vectors, [key_col], tokens_col, "__pv")
    return (df.join(pv, key_col, "left")
              .withColumn(out_col, F.coalesce("__pv", zero_vector(dim))).drop("__pv"))


def period_vector_sum(post_vecs: DataFrame, keys: Sequence[str], vec_col: str = "vec",
                      out_col: str = "vec_sum") -> DataFrame:
    return (post_vecs.groupBy(*keys)
            .agg(Summarizer.sum(array_to_vector(vec_col)).alias("__s"))
            .select(*keys, vector_to_array("__s", "float64").alias(out_col)))


def attach_period_mean(periods: DataFrame, sums: DataFrame, keys: Sequence[str], dim: int,
                       n_col: str = "n_posts", sum_col: str = "vec_sum",
                       out_col: str = "vec") -> DataFrame:
    """Period mean vector = sum of post vectors / post count (zeros if none)."""
    out = periods.join(sums, list(keys), "left")
    mean = F.transform(F.col(sum_col), lambda x: x / F.col(n_col))
    return out.withColumn(out_col, F.coalesce(mean, zero_vector(dim))).drop(sum_col)


def period_mean_vector(df: DataFrame, keys: Sequence[str], vec_col: str,
                       out_col: str = "vec") -> DataFrame:
    """Element-wise mean of a vector column per group (A1 for vectors)."""
    return (df.groupBy(*keys).agg(Summarizer.mean(array_to_vector(
                F.col(vec_col).cast("array<double>"))).alias("__m"),
                F.count(F.lit(1)).alias("n_posts"))
              .select(*keys, "n_posts", vector_to_array("__m", "float64").alias(out_col)))


def hashed_token_counts(df: DataFrame, keys: Sequence[str], dim: int,
                        tokens_col: str = "tokens") -> DataFrame:
    """``keys..., bucket, n``: a hashed bag of words per period; only scalars are shuffled."""
    return (token_rows(df, list(keys), tokens_col).withColumn("bucket", token_bucket("token", dim))
            .groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n")))


def hashed_vector_sum(df: DataFrame, keys: Sequence[str], dim: int, tokens_col: str = "tokens",
                      out_col: str = "vec_sum") -> DataFrame:
    """Per period the sum of its posts' hashed bags of words, as an array of ``dim`` counts."""
    pairs = (hashed_token_counts(df, keys, dim, tokens_col).groupBy(*keys)
             .agg(F.collect_list("bucket").alias("__b"), F.collect_list(F.col("n").cast("double")).alias("__n")))
    place = lambda i: F.coalesce(F.get("__n", (F.array_position("__b", i) - 1).cast("int")), F.lit(0.0))
    return pairs.select(*keys, F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.when(
            F.array_contains("__b", i), place(i)).otherwise(F.lit(0.0))).alias(out_col))


def hashing_encoder(dim: int) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Factory of a batch encoder: L2-normalised hashed bag of words.

    Stands in for a transformer encoder (none is installable here); any
    ``make_predict_fn`` with the same contract can replace it. The distinct
    words of a batch are hashed once and counted with array operations.
    """
    def make():
        import zlib

        def predict(texts: np.ndarray) -> np.ndarray:
            split = [str(t or "").split() for t in texts]
            found = np.array([w for ws in split for w in ws], dtype=object)
            row = np.repeat(np.arange(len(split)), [len(ws) for ws in split])
            words, which = np.unique(found.astype(str), return_inverse=True)
            place = np.array([zlib.crc32(w.encode("utf-8")) % dim for w in words.tolist()], np.int64)
            at = row * dim + place[which] if len(found) else np.zeros(0, np.int64)
            out = np.bincount(at, minlength=len(split) * dim).reshape(-1, dim).astype(np.float32)
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            np.divide(out, norms, out=out, where=norms > 0)
            return out
        return predict
    return make


def encode_text(df: DataFrame, text_col: str, dim: int,
                make_encoder: Callable | None = None, batch_size: int = 128,
                out_col: str = "vec", tokens_col: str | None = None) -> DataFrame:
    """Batched text -> vector encoder (the pluggable ``encode_text``).

    ``make_encoder=None`` uses JVM ``HashingTF`` over ``tokens_col`` (no
    Python). Otherwise ``make_encoder`` is a ``make_predict_fn`` for
    ``predict_batch_udf``: Arrow batches of ``batch_size`` texts per call,
    the model loaded once per Python worker.
    """
    if make_encoder is None:
        if tokens_col is None:
            raise ValueError("tokens_col is required for the hashing encoder")
        tf = HashingTF(inputCol=tokens_col, outputCol="__tf", numFeatures=dim)
        return tf.transform(df).withColumn(out_col, vector_to_array("__tf", "float64")).drop("__tf")
    enc = predict_batch_udf(make_encoder, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    return df.withColumn(out_col, enc(F.coalesce(F.col(text_col), F.lit(""))))
