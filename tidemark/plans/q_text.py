"""Registered queries: cleaning, tokens, stop words, phrases, dictionary,
spelling, lemmas, sentiment (SURVEY §7.2 steps 2-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import (
    clean_regex,
    join_tokens,
    phrase_hits,
    token_rows,
    tokenize,
)
from tidemark.operators.lemma import lemmatize_tokens
from tidemark.operators.periods import aggregate_periods
from tidemark.operators.sentiment import sentiment_score
from tidemark.operators.spelling import correct_tokens
from tidemark.operators.text import frequency_dictionary, vocabulary, with_tokens
from tidemark.plans import sqlfrag as S
from tidemark.plans.registry import query
from tidemark.plans.resources import (
    benchmark_lexicon,
    benchmark_rules,
    corpus_dictionary,
    english_documents,
    lemma_exceptions,
)
from tidemark.sources.adapters import conversation_posts, document_posts, text_table

R = 6


def _docs(spark, sf_dir):
    return text_table(spark, sf_dir, "documents", "doc_id")


@query("clean_regex", sql=f"SELECT doc_id, {S.clean('text')} AS clean FROM documents")
def q_clean_regex(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", clean_regex("text").alias("clean"))


@query("tokens", sql=f"""
SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token
FROM (SELECT doc_id, {S.tokens(S.clean('text'))} AS t FROM documents)""")
def q_tokens(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", tokenize(clean_regex("text")).alias("tokens"))
    return token_rows(docs, ["doc_id"], pos="pos")


@query("stopword_filter", sql=f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS clean
FROM (SELECT doc_id, {S.drop_stop(S.tokens(S.clean('text')))} AS t FROM documents)""")
def q_stopword_filter(spark, sf_dir):
    df = with_tokens(_docs(spark, sf_dir))
    return df.select("doc_id", F.size("tokens").alias("n_tokens"),
                     join_tokens("tokens").alias("clean"))


@query("phrase_hits", sql=f"""
SELECT doc_id, {S.phrase_hits("array_to_string(t, ' ')")} AS phrase_hits
FROM (SELECT doc_id, {S.drop_stop(S.tokens(S.clean('text')))} AS t FROM documents)""")
def q_phrase_hits(spark, sf_dir):
    df = with_tokens(_docs(spark, sf_dir))
    return df.select("doc_id", phrase_hits(join_tokens("tokens")).alias("phrase_hits"))


@query("frequency_dictionary", sql=f"WITH {S.EN_COUNTS} SELECT term, cnt FROM en_counts")
def q_frequency_dictionary(spark, sf_dir):
    docs = with_tokens(english_documents(spark, sf_dir), stop_words=None)
    return frequency_dictionary(docs, "tokens")


# Spelling: every distinct stop-filtered token of all documents against the
# whole dictionary of the English ones.
@query("spell_correct", sql=f"""
WITH {S.EN_COUNTS}, {S.TOKS}, {S.SPELLED}
SELECT token, corrected, CAST(distance AS INTEGER) AS distance FROM spelled""")
def q_spell_correct(spark, sf_dir):
    toks = vocabulary(with_tokens(_docs(spark, sf_dir)))
    return correct_tokens(toks, corpus_dictionary(spark, sf_dir))


@query("lemma_lookup", sql=f"""
WITH RECURSIVE {S.EN_COUNTS}, {S.TOKS}, {S.lemmas('toks')}
SELECT token, lemma FROM lemma_of""")
def q_lemma_lookup(spark, sf_dir):
    toks = vocabulary(with_tokens(_docs(spark, sf_dir)))
    vocab = corpus_dictionary(spark, sf_dir).select("term")
    return lemmatize_tokens(toks, vocab, lemma_exceptions(spark))


@query("sentiment_abs", sql=f"""
WITH {S.LEXICON},
toks AS (SELECT doc_id, unnest({S.drop_stop(S.tokens(S.clean('text')))}) AS token FROM documents),
sums AS (SELECT t.doc_id, sum(l.valence) AS s FROM toks t JOIN lexicon l ON t.token = l.token GROUP BY ALL)
SELECT d.doc_id, {S.compound('s.s')} AS sentiment
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id""")
def q_sentiment_abs(spark, sf_dir):
    df = with_tokens(_docs(spark, sf_dir))
    return sentiment_score(df, benchmark_lexicon(spark, sf_dir), key_col="doc_id").select(
        "doc_id", "sentiment")


@query("sentiment_abs_join", sql=f"""
WITH {S.LEXICON},
toks AS (SELECT doc_id, unnest({S.drop_stop(S.tokens(S.clean('text')))}) AS token FROM documents),
sums AS (SELECT t.doc_id, sum(l.valence) AS s FROM toks t JOIN lexicon l ON t.token = l.token GROUP BY ALL)
SELECT d.doc_id, {S.compound('s.s')} AS sentiment
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id""",
       note="same as sentiment_abs, forcing the join path of a lexicon above the map limit")
def q_sentiment_abs_join(spark, sf_dir):
    df = with_tokens(_docs(spark, sf_dir))
    return sentiment_score(df, benchmark_lexicon(spark, sf_dir), key_col="doc_id",
                           inline_keys=0).select("doc_id", "sentiment")


SENTIMENT_RULES_SQL = f"""
WITH {S.LEXICON},
toks AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos
         FROM (SELECT doc_id, {S.drop_stop(S.tokens(S.clean('text')))} AS tokens FROM documents)),
v AS (SELECT t.doc_id, t.pos, coalesce(l.valence, 0.0) AS v,
             CASE WHEN l.valence = 0 AND length(t.token) = 4 AND t.token[1:1] <= 'l'
                  THEN CASE WHEN t.token[-1:] = 'e' THEN -0.293 ELSE 0.293 END ELSE 0 END::DOUBLE AS b,
             CASE WHEN l.valence = 0 AND length(t.token) = 4 AND t.token[1:1] > 'l' THEN 1 ELSE 0 END AS n,
             CASE WHEN l.valence = 0 AND length(t.token) = 13 THEN t.pos END AS c
      FROM toks t LEFT JOIN lexicon l ON t.token = l.token),
w AS (SELECT doc_id, pos, v, min(c) OVER (PARTITION BY doc_id) AS c,
             coalesce(lag(b, 1) OVER o, 0) + coalesce(lag(b, 2) OVER o, 0) * 0.95::DOUBLE
               + coalesce(lag(b, 3) OVER o, 0) * 0.9::DOUBLE AS boost,
             coalesce(lag(n, 1) OVER o, 0) + coalesce(lag(n, 2) OVER o, 0) + coalesce(lag(n, 3) OVER o, 0) AS neg
      FROM v WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
sums AS (SELECT doc_id, sum((v + sign(v) * boost) * pow(-0.74::DOUBLE, neg)
                            * CASE WHEN pos < c THEN 0.5 WHEN pos > c THEN 1.5 ELSE 1 END) AS s
         FROM w WHERE v <> 0 GROUP BY doc_id)
SELECT d.doc_id, {S.compound('s.s')} AS sentiment
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id"""


@query("sentiment_rules", sql=SENTIMENT_RULES_SQL)
def q_sentiment_rules(spark, sf_dir):
    """Valences in context: boosters, negators and a contrast word."""
    df = with_tokens(_docs(spark, sf_dir))
    return sentiment_score(df, benchmark_lexicon(spark, sf_dir), key_col="doc_id",
                           rules=benchmark_rules(spark, sf_dir)).select("doc_id", "sentiment")


@query("sentiment_rules_join", sql=SENTIMENT_RULES_SQL, note="the join path of a lexicon above the map limit")
def q_sentiment_rules_join(spark, sf_dir):
    df = with_tokens(_docs(spark, sf_dir))
    return sentiment_score(df, benchmark_lexicon(spark, sf_dir), key_col="doc_id", inline_keys=0,
                           rules=benchmark_rules(spark, sf_dir)).select("doc_id", "sentiment")


@query("sentiment_spread_by_period", sql=f"""
WITH {S.LEXICON}, {S.DOC_POSTS},
toks AS (SELECT post_id, unnest(tokens) AS token FROM posts),
sums AS (SELECT t.post_id, sum(l.valence) AS s FROM toks t JOIN lexicon l ON t.token = l.token GROUP BY ALL),
scored AS (SELECT p.*, {S.compound('s.s')} AS sentiment FROM posts p LEFT JOIN sums s ON p.post_id = s.post_id)
SELECT match_id, period_id, id, count(*) AS n_posts,
       round(avg(sentiment), {R}) AS sentiment, round(stddev_samp(sentiment), {R}) AS std_sentiment
FROM scored GROUP BY ALL""")
def q_sentiment_spread_by_period(spark, sf_dir):
    posts = with_tokens(document_posts(spark, sf_dir, labelled=False))
    posts = sentiment_score(posts, benchmark_lexicon(spark, sf_dir))
    p = aggregate_periods(posts, scalar_cols=["sentiment"], spread_cols=["sentiment"],
                          label_col=None)
    return p.select("match_id", "period_id", "id", "n_posts",
                    F.round("sentiment", R).alias("sentiment"),
                    F.round("std_sentiment", R).alias("std_sentiment"))


@query("sentiment_conversations", sql=f"""
WITH {S.LEXICON},
posts AS (
  SELECT CAST(conv_id AS VARCHAR) AS match_id, turn AS period_id,
         CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS id,
         conv_id * 2147483648 + turn AS post_id,
         {S.drop_stop(S.tokens(S.clean('text')))} AS tokens
  FROM conversations),
toks AS (SELECT post_id, unnest(tokens) AS token FROM posts),
sums AS (SELECT t.post_id, sum(l.valence) AS s FROM toks t JOIN lexicon l ON t.token = l.token GROUP BY ALL),
scored AS (SELECT p.*, {S.compound('s.s')} AS sentiment,
                  {S.phrase_hits("array_to_string(p.tokens, ' ')")} AS phrase_hits
           FROM posts p LEFT JOIN sums s ON p.post_id = s.post_id)
SELECT match_id, period_id, id, count(*) AS n_posts,
       round(avg(sentiment), {R}) AS sentiment, round(stddev_samp(sentiment), {R}) AS std_sentiment,
       round(avg(phrase_hits), {R}) AS phrase_hits
FROM scored GROUP BY ALL""")
def q_sentiment_conversations(spark, sf_dir):
    posts = with_tokens(conversation_posts(spark, sf_dir))
    posts = sentiment_score(posts, benchmark_lexicon(spark, sf_dir))
    posts = posts.withColumn("phrase_hits", phrase_hits(join_tokens("tokens")))
    p = aggregate_periods(posts, scalar_cols=["sentiment", "phrase_hits"],
                          spread_cols=["sentiment"], label_col=None)
    return p.select("match_id", "period_id", "id", "n_posts",
                    F.round("sentiment", R).alias("sentiment"),
                    F.round("std_sentiment", R).alias("std_sentiment"),
                    F.round("phrase_hits", R).alias("phrase_hits"))


@query("clean_text_full", sql=f"""
WITH RECURSIVE {S.TOKEN_MAP},
raw AS (SELECT doc_id, {S.drop_stop(S.tokens(S.clean('text')))} AS tokens FROM documents),
m AS ({S.mapped('raw', 'doc_id')})
SELECT r.doc_id, coalesce(array_to_string(m.tokens, ' '), '') AS clean,
       CAST(len(r.tokens) AS INTEGER) AS n_tokens
FROM raw r LEFT JOIN m USING (doc_id)""")
def q_clean_text_full(spark, sf_dir):
    from tidemark.operators.text import clean_text

    dictionary = corpus_dictionary(spark, sf_dir)
    out = clean_text(_docs(spark, sf_dir).select(F.col("doc_id").alias("post_id"), "text"),
                     dictionary=dictionary, lemma_vocab=dictionary.select("term"),
                     lemma_exceptions=lemma_exceptions(spark))
    return out.select(F.col("post_id").alias("doc_id"), "clean", F.size("tokens").alias("n_tokens"))


@query("stopword_filter_antijoin", sql=f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS clean
FROM (SELECT doc_id, {S.drop_stop(S.tokens(S.clean('text')))} AS t FROM documents)""",
       note="stop list given as a table, applied by an anti join (the path for large stop tables)")
def q_stopword_filter_antijoin(spark, sf_dir):
    from tidemark.functions.fixed import ENGLISH_STOP_WORDS
    from tidemark.operators.text import remove_stopwords

    stop = spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "token string")
    docs = with_tokens(_docs(spark, sf_dir).select("doc_id", "text"), stop_words=None)
    out = remove_stopwords(docs.drop("text"), stop, key_col="doc_id", inline_limit=0)
    return out.select("doc_id", F.size("tokens").alias("n_tokens"),
                      join_tokens("tokens").alias("clean"))
