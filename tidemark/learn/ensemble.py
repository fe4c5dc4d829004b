"""Stacking (M7), bagging (M8) and the soft vote (A10).

Stacking: rows get a fold from a seeded hash of their key (or of a group
column, so a match never feeds its own out-of-fold score); every base
learner is fitted on k-1 folds and scores the held-out fold; the union of
held-out scores trains the meta learner; bases are refitted on all rows.

Bagging: replica r weights every row by a Poisson(1) draw from a seeded
hash of (key, r) - the distributed bootstrap - and fits the base with that
weight column; rows drawn 0 times are filtered out. Scores are averaged
(soft vote) and thresholded at 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import SEED
from tidemark.functions.hashing import seeded_hash, seeded_uniform
from tidemark.learn.evaluate import score_column

# Independent fits submitted together from driver threads (Spark runs their
# jobs concurrently, as CrossValidator(parallelism=) does).
DEFAULT_PARALLELISM = 8


def fit_all(jobs: list[tuple], parallelism: int = DEFAULT_PARALLELISM) -> list:
    """Fit ``(estimator, frame)`` pairs; results in input order."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [est.fit(df) for est, df in jobs]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(jobs))) as pool:
        return list(pool.map(lambda job: job[0].fit(job[1]), jobs))


@contextmanager
def kept(df: DataFrame):
    """``df`` persisted for the fits inside (unless it is already)."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def poisson_weight(cols: Sequence[str], replica: int, seed: int, max_k: int = 12) -> Column:
    """Poisson(1) count by inverse CDF of a hash uniform; counts above ``max_k`` (probability below
    1e-10) are ``max_k``."""
    u = seeded_uniform(list(cols), replica, seed)
    cdf, term, k = 0.0, math.exp(-1.0), F.lit(0)
    for j in range(max_k):
        cdf += term
        term /= (j + 1)
        k = k + F.when(u >= F.lit(cdf), 1).otherwise(0)
    return k.cast("double")


def fold_of(cols: Sequence[str], num_folds: int, seed: int) -> Column:
    """The fold of a row, from a seeded hash of its key (or of a group column)."""
    return (seeded_hash(list(cols), seed) % num_folds).cast("int")


class StackingModel:
    def __init__(self, bases: dict, meta, names: list[str]):
        self.bases, self.meta, self.names = bases, meta, names

    def transform(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        x = df
        for name in self.names:
            x = score_column(self.bases[name], x, f"__p_{name}")
        x = VectorAssembler(inputCols=[f"__p_{n}" for n in self.names],
                            outputCol="__meta").transform(x)
        out = self.meta.transform(x)
        keep = [c for c in out.columns if c in cols or c in ("rawPrediction", "probability",
                                                              "prediction")]
        return out.select(*keep)


class StackingEstimator:
    def __init__(self, bases: dict, meta, num_folds: int = 3, seed: int = SEED,
                 key_cols: Sequence[str] = ("id",), fold_by: str | None = None,
                 weight_col: str | None = None, parallelism: int = DEFAULT_PARALLELISM):
        self.bases, self.meta = bases, meta
        self.num_folds, self.seed = num_folds, seed
        self.key_cols, self.fold_by, self.weight_col = list(key_cols), fold_by, weight_col
        self.parallelism = parallelism

    def fold_column(self) -> Column:
        cols = [self.fold_by] if self.fold_by else self.key_cols
        return fold_of(cols, self.num_folds, self.seed)

    def base_jobs(self, df: DataFrame) -> list[tuple]:
        """Every (fold, base) fit and every full refit, all independent."""
        names = list(self.bases)
        data = df.withColumn("__fold", self.fold_column())
        jobs = [(self.bases[n], data.where(F.col("__fold") != f))
                for f in range(self.num_folds) for n in names]
        return jobs + [(self.bases[n], df) for n in names]

    def from_bases(self, df: DataFrame, models: list) -> StackingModel:
        """Fit the meta learner on the out-of-fold scores of ``base_jobs``' models."""
        names = list(self.bases)
        data = df.withColumn("__fold", self.fold_column())
        held_parts = []
        for f in range(self.num_folds):
            held = data.where(F.col("__fold") == f)
            for i, name in enumerate(names):
                held = score_column(models[f * len(names) + i], held, f"__p_{name}")
            held_parts.append(held)
        oof = held_parts[0]
        for part in held_parts[1:]:
            oof = oof.unionByName(part)
        oof = VectorAssembler(inputCols=[f"__p_{n}" for n in names],
                              outputCol="__meta").transform(oof)
        meta = self.meta.copy({self.meta.getParam("featuresCol"): "__meta"})
        meta_model = meta.fit(oof)
        refits = models[self.num_folds * len(names):]
        return StackingModel(dict(zip(names, refits)), meta_model, names)

    def fit(self, df: DataFrame) -> StackingModel:
        with kept(df) as data:
            return self.from_bases(data, fit_all(self.base_jobs(data), self.parallelism))


class BaggingModel:
    def __init__(self, models: list):
        self.models = models

    def transform(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        x = df
        for i, m in enumerate(self.models):
            x = score_column(m, x, f"__b{i}")
        p = sum((F.col(f"__b{i}") for i in range(len(self.models))), F.lit(0.0)) / len(self.models)
        return x.select(*cols, p.alias("p1"),
                        (p > F.lit(0.5)).cast("double").alias("prediction"))


class BaggingEstimator:
    """``make_base(weight_col)`` builds a fresh base estimator using that weight column."""

    def __init__(self, make_base: Callable, num_models: int = 10, seed: int = SEED,
                 key_cols: Sequence[str] = ("id",), parallelism: int = DEFAULT_PARALLELISM):
        self.make_base, self.num_models = make_base, num_models
        self.seed, self.key_cols = seed, list(key_cols)
        self.parallelism = parallelism

    def fit(self, df: DataFrame) -> BaggingModel:
        with kept(df) as source:
            replicas = []
            for r in range(self.num_models):
                w = poisson_weight(self.key_cols, r, self.seed)
                replicas.append((self.make_base("__bw"),
                                 source.withColumn("__bw", w).where(F.col("__bw") > 0)))
            if not all(isinstance(est, StackingEstimator) for est, _ in replicas):
                return BaggingModel(fit_all(replicas, self.parallelism))
            # one pool over the base fits of all stacks, then one over their meta learners
            per = [est.base_jobs(data) for est, data in replicas]
            models = fit_all([job for jobs in per for job in jobs], self.parallelism)
            parts, at = [], 0
            for jobs in per:
                parts.append(models[at:at + len(jobs)])
                at += len(jobs)
            with ThreadPoolExecutor(max_workers=max(1, self.parallelism)) as pool:
                return BaggingModel(list(pool.map(
                    lambda x: x[0][0].from_bases(x[0][1], x[1]), zip(replicas, parts))))


def bagged_vote(scored: DataFrame, key_cols: Sequence[str], score_col: str = "p1",
                threshold: float = 0.5) -> DataFrame:
    """Soft vote: mean score per key over replicas, class 1 above ``threshold``."""
    return (scored.groupBy(*key_cols).agg(F.avg(score_col).alias("p1"),
                                          F.count(F.lit(1)).alias("n_models"))
                  .withColumn("prediction", (F.col("p1") > F.lit(threshold)).cast("double")))
