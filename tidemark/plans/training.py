"""Train and score: the original program's two entry points as one plan.

``train``: feature table -> assembled vectors -> fit (any estimator or
ensemble). ``score``: same features for new posts -> ``model.transform`` ->
``id, event_type``. Keys stay on every row from scan to prediction.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.learn.estimators import logistic
from tidemark.learn.graph import FittedModels, fit_models, leaderboard, main_program, sweep_models
from tidemark.plans.features import CONFIGS, Resources, assemble, build_features
from tidemark.plans.resources import (
    benchmark_lexicon,
    corpus_dictionary,
    corpus_word_vectors,
    embedding_dim,
    lemma_exceptions,
)
from tidemark.session import cached
from tidemark.sources.adapters import document_posts
from tidemark.sources.io import materialize


def document_resources(spark: SparkSession, sf_dir: str, configs=None) -> Resources:
    """Full cleaning (spelling + lemmas) and the feature resources that ``configs`` use (None: all)."""
    dictionary = corpus_dictionary(spark, sf_dir)
    words = configs is None or any(CONFIGS[c].embedding == "words" for c in configs)
    return Resources(dictionary=dictionary, lemma_vocab=dictionary.select("term"),
                     lemma_exceptions=lemma_exceptions(spark),
                     word_vectors=corpus_word_vectors(spark, sf_dir) if words else None,
                     dim=embedding_dim(spark, sf_dir) if words else None, lexicon=benchmark_lexicon(spark, sf_dir))


# Rows of a training table in a partition. Iterative learners run many small jobs, so a small table has few.
TRAIN_ROWS = 50_000
TRAIN_PARTITIONS = 2


def train_partitions(rows: DataFrame) -> int:
    """Partitions of a training table, by its number of rows."""
    return max(TRAIN_PARTITIONS, -(-rows.count() // TRAIN_ROWS))


def train(features: DataFrame, config: str, estimator, partitions: int | None = None, key: str = "id"):
    """Fit a ``pyspark.ml`` ``estimator`` on the labelled periods of a feature table.

    The training table (one row per period) is dealt to ``partitions`` (one for
    ``TRAIN_ROWS`` rows, ``TRAIN_PARTITIONS`` at least) by a hash of its key,
    sorted within them and persisted for the fit, so the same periods give the
    same model whatever the partitioning of their source. (Another number of
    partitions gives another ``pyspark.ml`` forest: its bootstrap is drawn per
    partition.)
    """
    rows = assemble(features, config).where(F.col("label").isNotNull())
    data = rows.repartition(partitions or train_partitions(rows), key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(data)
    finally:
        data.unpersist()


def score(model, features: DataFrame, config: str) -> DataFrame:
    """``id, event_type`` for every period of ``features``."""
    data = assemble(features, config, label_col="__none__")
    out = model.transform(data)
    return out.select("id", F.col("prediction").cast("double").alias("event_type"))


def flagship(spark: SparkSession, sf_dir: str, config: str = "volume_sentiment",
             estimator=None) -> DataFrame:
    """Documents as posts: clean -> features -> fit on labelled periods ->
    predict every period. Returns ``id, event_type, labelled``."""
    res = document_resources(spark, sf_dir, [config])
    feats = build_features(document_posts(spark, sf_dir), config, res, label_agg="max")
    model = train(feats, config, estimator or logistic())
    pred = score(model, feats, config)
    labelled = feats.select("id", F.col("event_type").isNotNull().alias("labelled"))
    return pred.join(labelled, "id")


MAIN = "main"


def train_models(features: DataFrame, config: str, models: dict, key: str = "id", **how) -> FittedModels:
    """Fit models of :mod:`tidemark.learn.graph` on the labelled periods of a feature table."""
    return fit_models(assemble(features, config).where(F.col("label").isNotNull()), models, [key], **how)


def main_program_predictions(spark: SparkSession, sf_dir: str, config: str = "volume_sentiment") -> DataFrame:
    """The original main program: bag of ten stacks, fitted on the labelled periods, predicting every period.

    Returns ``id, event_type, labelled``.
    """
    res = document_resources(spark, sf_dir, [config])
    feats = build_features(document_posts(spark, sf_dir), config, res, label_agg="max")
    pred = score(train_models(feats, config, {MAIN: main_program()}).model(MAIN), feats, config)
    return pred.join(feats.select("id", F.col("event_type").isNotNull().alias("labelled")), "id")


def feature_set_leaderboard(spark: SparkSession, sf_dir: str, configs, test_groups, models: dict | None = None) -> DataFrame:
    """The sweep of the original scripts: for each feature configuration, all 16 models (or ``models``) fitted on the
    periods of the training groups, and their accuracy on the held-out groups (``feature_set, model, accuracy``).

    Posts are fully cleaned once for all configurations; configurations are fitted side by side.
    """
    from tidemark.operators.split import split_by_group
    from tidemark.operators.text import clean_text

    res = document_resources(spark, sf_dir, configs)
    posts = cached(clean_text(document_posts(spark, sf_dir), stop_words=res.stop_words,
                              dictionary=res.dictionary, lemma_vocab=res.lemma_vocab,
                              lemma_exceptions=res.lemma_exceptions))

    def board(config: str) -> DataFrame:
        feats = build_features(posts, config, res, label_agg="max", cleaned=True)
        data = materialize(split_by_group(assemble(feats, config).where(F.col("label").isNotNull()),
                                          "match_id", test_groups), "sweep")
        return leaderboard(data.where(F.col("split") == "train"), data.where(F.col("split") == "test"),
                           models or sweep_models(), config)

    with ThreadPoolExecutor(max_workers=3) as pool:
        boards = list(pool.map(board, configs))
    out = boards[0]
    for b in boards[1:]:
        out = out.unionByName(b)
    return out
