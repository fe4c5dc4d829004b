import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.functions.fixed import REFERENCE_GROUP_IDS, REFERENCE_GROUP_PERIODS, REFERENCE_TEST_GROUP_IDS
from tidemark.learn.ensemble import BaggingEstimator, StackingEstimator, bagged_vote, poisson_weight
from tidemark.learn.estimators import base_learners, gbt, logistic, random_forest, rff_svc
from tidemark.learn.evaluate import accuracy, leaderboard
from tidemark.operators.split import positional_split, sample_groups, split_by_group


def _periods(spark, n=2300):
    rows = [(f"m{i % 23:02d}", i // 23, f"m{i % 23:02d}:{i // 23}") for i in range(n)]
    return spark.createDataFrame(rows, "match_id string, period_id long, id string")


def test_positional_split_matches_literal_walk(spark):
    periods = _periods(spark)
    got = {r.id: r.split for r in positional_split(periods, REFERENCE_GROUP_IDS, REFERENCE_GROUP_PERIODS,
                                                   REFERENCE_TEST_GROUP_IDS).collect()}
    keys = sorted((r.match_id, r.period_id, r.id) for r in periods.collect())
    want, index = {}, 0
    for g, n in zip(REFERENCE_GROUP_IDS, REFERENCE_GROUP_PERIODS):
        for _ in range(n):
            if index >= len(keys):
                break
            want[keys[index][2]] = "test" if g in REFERENCE_TEST_GROUP_IDS else "train"
            index += 1
    for k in keys[index:]:
        want[k[2]] = None
    assert got == want


def test_group_split_disjoint_and_complete(spark):
    periods = _periods(spark)
    test = sample_groups(periods, "match_id", 0.3, 42)
    assert test.count() == int(0.3 * 23)
    out = split_by_group(periods, "match_id", test)
    per_group = out.groupBy("match_id").agg(F.countDistinct("split").alias("k")).collect()
    assert all(r.k == 1 for r in per_group)
    assert out.count() == periods.count()
    again = {r[0] for r in sample_groups(periods.repartition(3), "match_id", 0.3, 42).collect()}
    assert again == {r[0] for r in test.collect()}


def _separable(spark, n=400, d=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    rows = [(i, x[i].tolist(), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, f array<double>, label double")
    return df.select("id", array_to_vector("f").alias("features"), "label")


def test_learners_fit_separable_data(spark):
    df = _separable(spark)
    train, test = df.where(F.col("id") % 4 != 0), df.where(F.col("id") % 4 == 0)
    models = {"lr": logistic(100), "rf": random_forest(20, 5), "gbt": gbt(10, 0.3, 3),
              "svc": rff_svc(128, max_iter=50)}
    board = {r.model: r.accuracy for r in leaderboard(train, test, models, "synthetic").collect()}
    assert board["lr"] > 0.9 and board["rf"] > 0.85 and board["gbt"] > 0.85 and board["svc"] > 0.8


def test_stack_and_bag(spark):
    df = _separable(spark, n=300, seed=1)
    train, test = df.where(F.col("id") % 4 != 0), df.where(F.col("id") % 4 == 0)
    bl = base_learners("small")
    stack = StackingEstimator({k: bl[k] for k in ("rf170", "xgb170", "lr")}, logistic(50),
                              num_folds=3, key_cols=["id"])
    acc = accuracy(stack.fit(train).transform(test)).first().accuracy
    assert acc > 0.85

    def make(w):
        b = base_learners("small", w)
        return StackingEstimator({k: b[k] for k in ("rf170", "lr")}, logistic(50, weight_col=w),
                                 num_folds=2, key_cols=["id"], weight_col=w)
    bag = BaggingEstimator(make, num_models=2, key_cols=["id"]).fit(train)
    out = bag.transform(test)
    assert accuracy(out).first().accuracy > 0.85
    assert out.count() == test.count()


def test_poisson_weights_mean_one(spark):
    w = spark.range(20000).select(poisson_weight(["id"], 0, 42).alias("w"))
    r = w.agg(F.avg("w").alias("m"), F.avg((F.col("w") == 0).cast("double")).alias("z")).first()
    assert abs(r.m - 1.0) < 0.03 and abs(r.z - np.exp(-1)) < 0.02


def test_bagged_vote(spark):
    s = spark.createDataFrame([(1, 0.9), (1, 0.3), (2, 0.2), (2, 0.4), (3, 0.5), (3, 0.5)],
                              "k long, p double")
    out = {r.k: (round(r.p1, 6), r.prediction) for r in bagged_vote(s, ["k"], "p").collect()}
    assert out == {1: (0.6, 1.0), 2: (0.3, 0.0), 3: (0.5, 0.0)}


def test_parallel_fits_equal_serial(spark):
    df = _separable(spark, n=200, seed=2)
    train, test = df.where(F.col("id") % 4 != 0), df.where(F.col("id") % 4 == 0)

    def preds(par):
        bl = base_learners("small")
        est = StackingEstimator({k: bl[k] for k in ("rf170", "lr")}, logistic(50), num_folds=2,
                                key_cols=["id"], parallelism=par)
        out = est.fit(train).transform(test)
        return sorted((r.id, r.prediction, round(float(r.probability[1]), 9)) for r in out.collect())
    assert preds(1) == preds(4)
