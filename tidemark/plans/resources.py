"""Lexical resources derived from the provided tables.

The original program loads an 80k-term frequency dictionary, 200-d word
vectors, a stop list, a lemma database and a sentiment lexicon. None ships
with the data here, and the invented prose matches few real English words,
so the fixtures are derived from the tables by fixed rules:

* dictionary: token counts of the English documents (``lang='en'``), all
  terms (the documents of the other languages have the words to correct);
* word vectors: English-document tokens (stop words removed) ranked by
  (count desc, token asc); rank r takes ``embeddings.embedding`` of
  ``vec_id = r``; tokens past the last vector are out of vocabulary;
* lemma vocabulary: the dictionary terms;
* sentiment lexicon: the distinct tokens of ``benchmark`` (whose passages
  recur inside the documents), valence ``((length mod 9) - 4) / 2``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fixed import ENGLISH_STOP_WORDS, NOUN_EXCEPTIONS
from tidemark.functions.text import clean_regex, token_rows, tokenize
from tidemark.operators.periods import global_row_index
from tidemark.operators.sentiment import SentimentRules
from tidemark.operators.text import frequency_dictionary, with_tokens
from tidemark.sources.adapters import read_table, text_table
from tidemark.sources.io import materialize

def english_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_table(spark, sf_dir, "documents", "doc_id").where(F.col("lang") == "en")


def corpus_dictionary(spark: SparkSession, sf_dir: str,
                      min_count: int = 1) -> DataFrame:
    """Written once (one row per term): it is read by several branches of
    the spelling and lemma plans, each of which would re-clean the text."""
    docs = with_tokens(english_documents(spark, sf_dir), stop_words=None)
    return materialize(frequency_dictionary(docs, "tokens", min_count), "dictionary")


def corpus_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word, vec array<float>``.

    The rank is a global order, but over the *distinct vocabulary* with its
    counts (one row per token), joined to the vector table on the rank.
    """
    docs = with_tokens(english_documents(spark, sf_dir), stop_words=ENGLISH_STOP_WORDS)
    counts = frequency_dictionary(docs, "tokens")
    ranked = (global_row_index(counts, [F.desc("cnt"), F.asc("term")], "rank")
              .withColumn("vec_id", F.col("rank") - 1))
    vecs = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return materialize(ranked.join(vecs, ranked["vec_id"] == vecs["vec_id"])
                       .select(F.col("term").alias("word"), F.col("embedding").alias("vec")), "word-vectors")


def embedding_dim(spark: SparkSession, sf_dir: str) -> int:
    return read_table(spark, sf_dir, "embeddings").select(F.size("embedding")).first()[0]


def benchmark_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = read_table(spark, sf_dir, "benchmark")
    toks = token_rows(bench.select(tokenize(clean_regex("text")).alias("tokens")), []).distinct()
    return toks.withColumn(
        "valence", ((F.length("token") % 9) - 4).cast("double") / F.lit(2.0))


def benchmark_rules(spark: SparkSession, sf_dir: str) -> SentimentRules:
    """Rule terms from the lexicon's tokens without valence: of length 4 those up to ``l`` boost (0.293, damping if they
    end in ``e``) and the others negate; those of length 13 contrast."""
    words = benchmark_lexicon(spark, sf_dir).where(F.col("valence") == 0).select("token")
    four, low = words.where(F.length("token") == 4), F.substring("token", 1, 1) <= "l"
    weight = F.when(F.col("token").endswith("e"), -0.293).otherwise(0.293)
    return SentimentRules(boosters=four.where(low).select("token", weight.alias("weight")),
                          negators=four.where(~low), contrasts=words.where(F.length("token") == 13))


def lemma_exceptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOUN_EXCEPTIONS), "token string, lemma string")
