"""Registered queries: learners, ensembles, vote, accuracy, leaderboard (step 6).

Learner input is ``embeddings``: features = ``embedding``, label = ``label % 2``,
key = ``vec_id``; a seeded hash of the key holds out ~30% as the test part.
Predictions are rows-only checks (learners differ from the original's
libraries); the vote, the accuracy, and properties that fix a fit - gradients,
histograms, leaf weights, purity, optimality conditions - are SQL-checked.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.fixed import SEED
from tidemark.learn.ensemble import bagged_vote, fold_of, kept, poisson_weight
from tidemark.learn.estimators import base_learners, logistic
from tidemark.learn.evaluate import accuracy
from tidemark.learn.fits import Boost, Fit, Forest, Kernel, fit_trees, row_leaves, training_table, tree_score, tree_sums
from tidemark.learn.graph import LEARNERS, Single, fit_models, leaderboard, main_program, sweep_models
from tidemark.learn.kernel import kernel_decisions, kernel_fits, solved_state
from tidemark.learn.levels import Growing, binned, histograms
from tidemark.operators.text import clean_text
from tidemark.plans.features import CONFIGS, build_features, training_maxima
from tidemark.plans.q_features import TEST_SOURCES
from tidemark.plans.registry import query
from tidemark.plans.training import (
    document_resources,
    feature_set_leaderboard,
    flagship,
    main_program_predictions,
    score,
    train,
    train_partitions,
)
from tidemark.session import cached
from tidemark.sources.adapters import document_posts, read_table

R = 6


def learner_input(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id",
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        (F.col("label") % 2).cast("double").alias("label"),
        (F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(10)) < 3).alias("is_test"))


def _split(spark, sf_dir):
    """Training and test part; the training part dealt by a hash of its key, so forests do not
    depend on the files' layout."""
    data = learner_input(spark, sf_dir)
    part = data.where(~F.col("is_test"))
    part = part.repartition(train_partitions(part), "vec_id").sortWithinPartitions("vec_id")
    return part, data.where(F.col("is_test"))


def _fit_predict(spark, sf_dir, est):
    part, test = _split(spark, sf_dir)
    with kept(part) as part:
        model = est.fit(part)
    return model.transform(test).select("vec_id", "label", F.col("prediction").cast("double").alias("prediction"))


@query("accuracy_of_rule", sql=f"""
SELECT count(*) AS n,
       round(avg(CASE WHEN (CASE WHEN embedding[1] > 0 THEN 1.0 ELSE 0.0 END) = CAST(label % 2 AS DOUBLE)
                      THEN 1.0 ELSE 0.0 END), {R}) AS accuracy
FROM embeddings""")
def q_accuracy_of_rule(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    scored = emb.select((F.col("label") % 2).cast("double").alias("label"),
                        (F.element_at("embedding", 1) > 0).cast("double").alias("prediction"))
    return accuracy(scored).select("n", F.round("accuracy", R).alias("accuracy"))


@query("bagged_vote", sql=f"""
SELECT vec_id, round(avg(p), {R}) AS p1, count(*) AS n_models,
       CAST(CASE WHEN avg(p) > 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
FROM (SELECT vec_id, 1.0 / (1.0 + exp(-10.0 * CAST(unnest(embedding[1:10]) AS DOUBLE))) AS p
      FROM embeddings)
GROUP BY vec_id""")
def q_bagged_vote(spark, sf_dir):
    """Soft vote over 10 replica scores per row (here: fixed scores derived
    from the first 10 embedding values)."""
    emb = read_table(spark, sf_dir, "embeddings")
    scores = emb.select("vec_id", F.explode(F.slice("embedding", 1, 10)).alias("x")).select(
        "vec_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-10.0) * F.col("x").cast("double"))))
        .alias("p"))
    v = bagged_vote(scores, ["vec_id"], "p")
    return v.select("vec_id", F.round("p1", R).alias("p1"), "n_models", "prediction")


@query("model_lr", note="rows-only; model_lr_gradient checks the fit")
def q_model_lr(spark, sf_dir):
    return _fit_predict(spark, sf_dir, logistic())


@query("model_lr_gradient", sql="""
SELECT CAST(i AS INTEGER) AS i, 0.0 AS gradient
FROM range((SELECT max(len(embedding)) FROM embeddings)) t(i)""",
       note="the regularised summed loss has one optimum, where its gradient is zero")
def q_model_lr_gradient(spark, sf_dir):
    """Gradient of the mean loss (L2 with C = 1 on the summed loss) at the fitted weights."""
    part, _ = _split(spark, sf_dir)
    with kept(part) as part:
        model = logistic().fit(part)
        n = part.count()
        w = [float(x) for x in model.coefficients]
        p = vector_to_array("probability").getItem(1)
        rows = (model.transform(part).select((p - F.col("label")).alias("e"), vector_to_array("features").alias("x"))
                .select("e", F.posexplode("x").alias("i", "x")).groupBy("i")
                .agg(F.sum(F.col("e") * F.col("x")).alias("s")).collect())
    grads = [(r["i"], round((r["s"] + w[r["i"]]) / n, 3) + 0.0) for r in rows]
    return spark.createDataFrame(grads, "i int, gradient double")


_HASH = "('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|{}'), 1, 13))::BIGINT"


@query("fold_ids", sql=f"""
SELECT vec_id, CAST({_HASH.format(SEED)} % 3 AS INTEGER) AS fold FROM embeddings""")
def q_fold_ids(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select("vec_id", fold_of(["vec_id"], 3, SEED).alias("fold"))


def _poisson_sql() -> str:
    u = f"{_HASH.format('{r}|' + str(SEED))} / 4503599627370496.0"
    cdf, term, out = 0.0, math.exp(-1.0), []
    for j in range(12):
        cdf += term
        term /= j + 1
        out.append(cdf)
    return " UNION ALL ".join(
        f"SELECT vec_id, {r} AS replica, CAST({' + '.join(f'CASE WHEN u >= {c!r} THEN 1 ELSE 0 END' for c in out)} "
        f"AS DOUBLE) AS weight FROM (SELECT vec_id, {u.format(r=r)} AS u FROM embeddings)" for r in range(10))


@query("bootstrap_weights", sql=_poisson_sql())
def q_bootstrap_weights(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    weights = F.array(*[poisson_weight(["vec_id"], r, SEED) for r in range(10)])
    return emb.select("vec_id", F.posexplode(weights).alias("replica", "weight"))


# Learners at the original's settings.

def _fitted(spark, sf_dir, models: dict):
    """Models fitted together on the training part, and the test part."""
    data = learner_input(spark, sf_dir)
    return fit_models(data.where(~F.col("is_test")), models, ["vec_id"]), data.where(F.col("is_test"))


def _predictions(spark, sf_dir, model):
    fitted, test = _fitted(spark, sf_dir, {"m": model})
    return fitted.transform(test).select("vec_id", "label", (F.col("p1")["m"] > 0.5).cast("double").alias("prediction"))


@query("model_rf", note="rows-only: 100 trees, no depth limit")
def q_model_rf(spark, sf_dir):
    return _predictions(spark, sf_dir, Single(LEARNERS["rf100"]))


@query("model_rf_170", note="rows-only: 170 trees, depth 10")
def q_model_rf_170(spark, sf_dir):
    return _predictions(spark, sf_dir, Single(LEARNERS["rf170"]))


@query("model_gbt", note="rows-only: Newton boosting, 100 rounds, rate 0.3, depth 6; boost_leaf_weights checks the fit")
def q_model_gbt(spark, sf_dir):
    return _predictions(spark, sf_dir, Single(LEARNERS["xgb100"]))


@query("model_gbt_170", note="rows-only: Newton boosting, 170 rounds, rate 0.1, depth 6")
def q_model_gbt_170(spark, sf_dir):
    return _predictions(spark, sf_dir, Single(LEARNERS["xgb170"]))


@query("model_rff_svc", note="rows-only: 256 random features, 100 iterations")
def q_model_rff_svc(spark, sf_dir):
    return _fit_predict(spark, sf_dir, base_learners()["svc"])


@query("model_svc", note="rows-only: Gaussian kernel, exact; kernel_svm_kkt checks the fit")
def q_model_svc(spark, sf_dir):
    fitted, test = _fitted(spark, sf_dir, {"m": Single(LEARNERS["svc"])})
    return fitted.transform(test).select("vec_id", "label", (F.col("p1")["m"] > 0).cast("double").alias("prediction"))


HISTOGRAM_EDGES = (-0.3, -0.2, -0.1, 0.0, 0.1, 0.2, 0.3)


def _histogram_sql() -> str:
    code = " + ".join(f"CASE WHEN x > {e!r} THEN 1 ELSE 0 END" for e in HISTOGRAM_EDGES)
    fold = _HASH.format(SEED)
    return f"""
WITH rows AS (SELECT embedding, CAST(label % 2 AS DOUBLE) AS y, {fold} % 3 AS fold,
                     CASE WHEN CAST(embedding[1] AS DOUBLE) <= 0.0 THEN 1 ELSE 2 END AS node FROM embeddings),
units AS (SELECT u AS unit, rows.* FROM rows, range(3) t(u) WHERE u = 2 OR fold <> u),
cells AS (SELECT unit, node, y, unnest(range(len(embedding))) AS col, CAST(unnest(embedding) AS DOUBLE) AS x FROM units)
SELECT CAST(unit AS INTEGER) AS unit, CAST(node AS INTEGER) AS node, CAST(col AS INTEGER) AS col,
       CAST({code} AS INTEGER) AS code, round(sum(0.5 - y), {R}) AS g, round(count(*) * 0.25, {R}) AS h, count(*) AS n
FROM cells GROUP BY ALL"""


@query("tree_histogram_level", sql=_histogram_sql())
def q_tree_histogram_level(spark, sf_dir):
    """Second level of three fits at once (fold 0 held out, fold 1 held out, all rows): the first round's gradient
    histograms of both children of a root split at feature 0 <= 0."""
    table = training_table(learner_input(spark, sf_dir), ["vec_id"])
    n_features = table.select(F.max(F.size("features"))).first()[0]
    edges = [np.array(HISTOGRAM_EDGES)] * n_features
    rows = binned(table, edges).withColumn("margins", F.array(F.lit(0.0)))
    trees = []
    for unit, held in enumerate((0, 1, None)):
        t = Growing(unit, Fit(Boost(), None, held), 0, 0, Boost().rules(n_features), 0)
        t.start()
        t.nodes.split(0, 0, 0.0, t.add(0.0, 0.0, 1, 1), t.add(0.0, 0.0, 2, 1))
        t.code[0], t.open = HISTOGRAM_EDGES.index(0.0), {1: 0, 2: 0}
        trees.append((t, [1, 2]))
    cells = histograms(rows, trees, n_features)
    return cells.select("unit", "node", "col", "code", F.round("g", R).alias("g"), F.round("h", R).alias("h"), "n")


@query("boost_leaf_weights", sql=f"""
SELECT CAST(r AS INTEGER) AS round, n, 0.0 AS weight_error, TRUE AS loss_falls
FROM range({LEARNERS["xgb100"].rounds}) t(r), (SELECT count(*) AS n FROM embeddings)""",
       note="100 rounds on all rows: leaf weights are -G / (H + 1) of the rows in the leaf, recomputed round by round")
def q_boost_leaf_weights(spark, sf_dir):
    """Every row's leaf and its weight per round; margins, gradients, leaf weights and losses are then recomputed by
    windows and aggregates."""
    learner = LEARNERS["xgb100"]
    table = training_table(learner_input(spark, sf_dir), ["vec_id"])
    steps = row_leaves(table.withColumn("rid", F.monotonically_increasing_id()), fit_trees(table, [Fit(learner)]),
                       ["rid", "label"])
    before = F.sum(F.col("value") * learner.rate).over(
        Window.partitionBy("rid").orderBy("tree").rowsBetween(Window.unboundedPreceding, -1))
    m = steps.withColumn("margin", F.coalesce(before, F.lit(0.0)))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
    loss = lambda z: F.log1p(F.exp(z)) - F.col("label") * z
    leaves = (m.groupBy("tree", "leaf").agg(
        F.sum(p - F.col("label")).alias("g"), F.sum(p * (1 - p)).alias("h"), F.max("value").alias("value"),
        F.count(F.lit(1)).alias("n"), F.sum(loss(F.col("margin"))).alias("old"),
        F.sum(loss(F.col("margin") + F.col("value") * learner.rate)).alias("new")))
    error = F.abs(-F.col("g") / (F.col("h") + learner.lam) - F.col("value"))
    return leaves.groupBy(F.col("tree").alias("round")).agg(
        F.sum("n").alias("n"), F.round(F.max(error), R).alias("weight_error"),
        (F.sum("new") <= F.sum("old")).alias("loss_falls"))


@query("forest_to_purity", sql="""
SELECT count(*) AS n, 1.0 AS accuracy, TRUE AS deep FROM embeddings""",
       note="labels that alternate along 97 values: a tree needs a depth above 40")
def q_forest_to_purity(spark, sf_dir):
    """Training accuracy of a forest without depth limit, and whether its trees are deeper than 40 levels."""
    forest = Forest(5, None, None, bootstrap=False)
    v = (F.col("vec_id") % 97).cast("double")
    table = training_table(read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.array(v).alias("features"), (v % 2).alias("label")), ["vec_id"])
    trees = fit_trees(table, [Fit(forest)])
    scored = tree_sums(table, trees, 1).select("label", (tree_score(Fit(forest), F.get("sums", F.lit(0))) > 0.5)
                                               .cast("double").alias("prediction"))
    deep = trees.select(F.expr(_DEPTH).alias("depth")).agg((F.min("depth") > 40).alias("deep"))
    return accuracy(scored).withColumn("deep", deep.scalar())


# Depth of a tree from its child arrays: children come after their parents.
_DEPTH = """array_max(aggregate(sequence(0, size(feature) - 1), array_repeat(0, size(feature)),
  (depth, i) -> transform(depth, (d, j) -> IF(j > 0 AND (j = left[i] OR j = right[i]), depth[i] + 1, d))))"""


@query("kernel_svm_kkt", sql="""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS violations, 0.0 AS balance FROM embeddings""",
       note="the optimality conditions of the dual on every row, from the support vectors' own decision values")
def q_kernel_svm_kkt(spark, sf_dir):
    fit, tol = Fit(Kernel()), 1e-3
    table = training_table(learner_input(spark, sf_dir), ["vec_id"])
    solved = solved_state(table, [fit], tol)
    scored = kernel_decisions(solved[0], kernel_fits(table, [fit], tol, solved=solved), 1)
    a, z = F.get("alpha", F.lit(0)), F.col("y") * F.get("decisions", F.lit(0))
    bad = (((a == 0) & (z < 1 - 2 * tol)) | ((a == fit.learner.C) & (z > 1 + 2 * tol))
           | ((a > 0) & (a < fit.learner.C) & (F.abs(z - 1) > 2 * tol)) | (a < 0) | (a > fit.learner.C))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum(bad.cast("long")).alias("violations"),
                      (F.round(F.abs(F.sum(a * F.col("y"))), R)).alias("balance"))


@query("stack", note="rows-only: rf170, xgb170, lr; three folds")
def q_stack(spark, sf_dir):
    return _predictions(spark, sf_dir, main_program().base)


@query("bag_of_stack", note="rows-only: ten replicas of the stack rf170, xgb170, lr on three folds")
def q_bag_of_stack(spark, sf_dir):
    return _predictions(spark, sf_dir, main_program())


@query("leaderboard", note="rows-only: the sweep's 16 models at the original's settings")
def q_leaderboard(spark, sf_dir):
    data = learner_input(spark, sf_dir)
    return leaderboard(data.where(~F.col("is_test")), data.where(F.col("is_test")), sweep_models(), "embedding", ["vec_id"])


@query("predictions_flagship", note="rows-only: clean -> features -> LR -> predictions")
def q_predictions_flagship(spark, sf_dir):
    return flagship(spark, sf_dir)


@query("predictions_scaled_per_match", note="rows-only: train with global maxima, score the "
       "unlabelled periods with maxima per match (per file), as the original scoring loop")
def q_predictions_scaled_per_match(spark, sf_dir):
    res, posts, model = _trained(spark, sf_dir)
    per_match = build_features(posts, "features_only", res, scale_by="match_id", label_agg="max", cleaned=True)
    return score(model, per_match.where(F.col("event_type").isNull()), "features_only")


@query("predictions_scaled_as_trained", note="rows-only: the unlabelled periods scaled by the "
       "maxima of the labelled ones")
def q_predictions_scaled_as_trained(spark, sf_dir):
    res, posts, model = _trained(spark, sf_dir)
    maxima = training_maxima(posts, "features_only", res, cleaned=True)
    feats = build_features(posts, "features_only", res, label_agg="max", cleaned=True, maxima=maxima)
    return score(model, feats.where(F.col("event_type").isNull()), "features_only")


def _trained(spark, sf_dir):
    res = document_resources(spark, sf_dir, ["features_only"])
    posts = cached(clean_text(document_posts(spark, sf_dir), dictionary=res.dictionary,
                              lemma_vocab=res.lemma_vocab, lemma_exceptions=res.lemma_exceptions))
    feats = build_features(posts, "features_only", res, label_agg="max", cleaned=True)
    return res, posts, train(feats, "features_only", logistic())


@query("predictions_main_program", note="rows-only: bagging (10) of a stack (rf170, xgb170, lr; three "
       "folds) on the volume_sentiment features")
def q_predictions_main_program(spark, sf_dir):
    return main_program_predictions(spark, sf_dir)


@query("leaderboard_feature_sets", note="rows-only: the 16 models on every feature configuration (96 rows), held out "
       "by group")
def q_leaderboard_feature_sets(spark, sf_dir):
    return feature_set_leaderboard(spark, sf_dir, tuple(CONFIGS), TEST_SOURCES)
