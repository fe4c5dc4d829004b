"""Text operators over posts: cleaning (J4-J6 composed with X1-X5), token
tables, the frequency dictionary (A9/S6) and phrase hits (A6).

Lookups that map a token to a replacement (spelling, lemma) are solved on
the *distinct* vocabulary, which grows far slower than the text, and only
the tokens that change are applied back to the posts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import ENGLISH_STOP_WORDS, SPELL_MAX_DISTANCE
from tidemark.functions.text import (
    clean_regex,
    join_tokens,
    remove_stopwords_col,
    token_rows,
    tokenize,
)
from tidemark.operators.lemma import lemmatize_tokens
from tidemark.operators.lookup import (
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_INLINE_KEYS,
    bounded_count,
    join_lookup,
)
from tidemark.operators.spelling import PREFIX_LENGTH, correct_tokens
from tidemark.sources.io import materialize


def with_tokens(posts: DataFrame, text_col: str = "text", out_col: str = "tokens",
                stop_words: Iterable[str] | DataFrame | None = ENGLISH_STOP_WORDS,
                key_col: str = "post_id") -> DataFrame:
    """Regex-clean and split ``text_col`` into ``out_col``; drop stop words.

    ``stop_words`` may be a list or a one-column DataFrame (see
    ``remove_stopwords``).
    """
    df = posts.withColumn(out_col, tokenize(clean_regex(text_col)))
    if isinstance(stop_words, DataFrame):
        return remove_stopwords(df, stop_words, out_col, key_col)
    if stop_words is not None:
        df = df.withColumn(out_col, remove_stopwords_col(out_col, stop_words))
    return df


def remove_stopwords(df: DataFrame, stop_df: DataFrame, tokens_col: str = "tokens",
                     key_col: str = "post_id",
                     inline_limit: int = DEFAULT_INLINE_KEYS) -> DataFrame:
    """Drop the tokens listed in ``stop_df`` (J4), order kept; NULLs in the list are ignored.

    A stop table within ``inline_limit`` rows (counted first) becomes a
    literal hash set in the projection. A larger one flags the narrow token
    rows ``(key, pos, token)`` by a left join; the unflagged ones are
    re-assembled in position order per post and joined back on the (unique)
    key, so no other column travels with the tokens.
    """
    words = (stop_df.select(F.col(stop_df.columns[0]).alias("token"))
             .where(F.col("token").isNotNull()).distinct())
    if bounded_count(words, inline_limit) is not None:
        return df.withColumn(tokens_col, remove_stopwords_col(
            tokens_col, [r.token for r in words.collect()]))
    rows = df.select(key_col, F.posexplode_outer(tokens_col).alias("pos", "token"))
    flags = words.withColumn("__stop", F.lit(True)).hint("shuffle_merge")
    kept = (rows.join(flags, "token", "left")
            .groupBy(key_col)
            .agg(F.array_sort(F.collect_list(
                F.when(F.col("token").isNotNull() & F.col("__stop").isNull(),
                       F.struct("pos", "token")))).alias("__t"))
            .select(key_col, F.transform("__t", lambda s: s["token"]).alias(tokens_col)))
    columns = df.columns
    return df.drop(tokens_col).join(kept, key_col).select(*columns)


def explode_tokens(df: DataFrame, keys: Iterable[str], tokens_col: str = "tokens",
                   with_pos: bool = True) -> DataFrame:
    return token_rows(df, list(keys), tokens_col, pos="pos" if with_pos else None)


def vocabulary(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Distinct tokens (partial aggregation before the shuffle)."""
    return token_rows(df, [], tokens_col).distinct()


def frequency_dictionary(df: DataFrame, tokens_col: str = "tokens",
                         min_count: int = 1) -> DataFrame:
    """``term, cnt`` over all tokens of ``df``."""
    counts = (token_rows(df, [], tokens_col, "term")
                .groupBy("term").agg(F.count(F.lit(1)).alias("cnt")))
    if min_count > 1:
        counts = counts.where(F.col("cnt") >= min_count)
    return counts


def token_mapping(vocab: DataFrame, dictionary: DataFrame | None = None,
                  lemma_vocab: DataFrame | None = None,
                  lemma_exceptions: DataFrame | None = None) -> DataFrame:
    """``token -> out`` for every vocabulary token: spelling correction
    against ``dictionary`` (term, cnt), then lemma lookup in ``lemma_vocab``.
    """
    mapping = vocab.select("token", F.col("token").alias("out"))
    if dictionary is not None:
        # One row per vocabulary word, read twice below (lemma input, join):
        # written once instead of running the spelling join twice.
        mapping = materialize(correct_tokens(vocab, dictionary)
                              .select("token", F.col("corrected").alias("out")), "spelled",
                              params=["osa by hashes of deletes", SPELL_MAX_DISTANCE, PREFIX_LENGTH],
                              parts=[vocab, dictionary])
    if lemma_vocab is not None:
        outs = mapping.select(F.col("out").alias("token")).distinct()
        lemmas = lemmatize_tokens(outs, lemma_vocab, lemma_exceptions)
        mapping = (mapping.join(lemmas.withColumnRenamed("token", "out"), "out", "left")
                          .select("token", F.coalesce("lemma", "out").alias("out")))
    return mapping


def apply_token_mapping(df: DataFrame, mapping: DataFrame, tokens_col: str = "tokens",
                        key_col: str = "post_id", drop: Iterable[str] = ("text",),
                        broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Replace the tokens of ``tokens_col`` by ``mapping`` (token, out).

    Only changed tokens are applied. Narrow token rows ``(key, pos, token)``
    are exploded, joined on token (broadcast when the changed set's counted bytes are
    within ``broadcast_bytes``, else sort-merge where AQE splits hot tokens)
    and re-assembled per post in position order; the post's other columns
    are joined back on ``key_col`` (unique, so no skew) rather than carried
    on every token row. Posts without tokens survive via
    ``posexplode_outer``. Columns in ``drop`` (raw text) are not kept.
    """
    changed = mapping.where(F.col("out") != F.col("token"))
    if key_col not in df.columns:
        raise ValueError(f"{key_col} must be a column of df")
    ex = df.select(key_col, F.posexplode_outer(tokens_col).alias("pos", "token"))
    fixed = (join_lookup(ex, changed, "token", "left", broadcast_bytes)
               .withColumn("token", F.coalesce("out", "token"))
               .groupBy(key_col)
               .agg(F.array_sort(F.collect_list(
                   F.when(F.col("token").isNotNull(), F.struct("pos", "token")))).alias("__toks")))
    fixed = fixed.select(key_col, F.transform("__toks", lambda s: s["token"]).alias(tokens_col))
    rest = df.drop(tokens_col, *[c for c in drop if c in df.columns])
    return rest.join(fixed, key_col)


def clean_text(posts: DataFrame, text_col: str = "text", out_col: str = "clean",
               tokens_col: str = "tokens",
               stop_words: Iterable[str] | None = ENGLISH_STOP_WORDS,
               dictionary: DataFrame | None = None,
               lemma_vocab: DataFrame | None = None,
               lemma_exceptions: DataFrame | None = None,
               key_col: str = "post_id",
               broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The composed cleaning operator (X1 -> X2 -> X3 -> X4 -> P5 -> J5 -> J6 -> X5).

    Adds ``tokens_col`` (array) and ``out_col`` (tokens joined by a space).
    A corrected word is not re-checked against the stop list, as in the
    original. Without ``dictionary``/``lemma_vocab`` everything is one
    projection; with them the raw ``text_col`` is not carried further.
    """
    df = with_tokens(posts, text_col, tokens_col, stop_words)
    if dictionary is not None or lemma_vocab is not None:
        # The tokens give the vocabulary and take the mapping, the distinct
        # vocabulary feeds several branches of the mapping plan: both are
        # written once instead of re-cleaning posts.
        df = materialize(df.drop(text_col), "tokens")
        vocab = materialize(vocabulary(df, tokens_col), "vocab")
        mapping = token_mapping(vocab, dictionary, lemma_vocab, lemma_exceptions)
        mapping = materialize(mapping.where(F.col("out") != F.col("token")), "token-map")
        df = apply_token_mapping(df, mapping, tokens_col, key_col, (text_col,), broadcast_bytes)
    return df.withColumn(out_col, join_tokens(tokens_col))
