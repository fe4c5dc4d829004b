"""Learners of the original sweep as pyspark.ml estimators, with presets.

* logistic regression, L2, C = 1 on a *summed* loss: Spark's loss is a mean,
  so ``regParam = 1 / (C * sum of weights)`` is set at fit time;
* random forest (100 trees, unlimited depth -> Spark's maximum 30;
  170 trees, depth 10, sqrt features);
* boosted trees (100 rounds, rate 0.3, depth 6 - the boosting library's
  public defaults; 170 rounds, rate 0.1, depth 6);
* RBF-kernel SVM approximated by random Fourier features + LinearSVC.

``preset="small"`` shrinks trees/rounds/iterations for unit tests; no registered query uses it.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasWeightCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import SEED
from tidemark.learn.rff import RandomFourierFeatures


class SummedLossLogistic(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter):
    C = Param(Params._dummy(), "C", "inverse L2 strength on the summed loss",
              typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", weightCol=None, maxIter=1000,
                 C=1.0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxIter=1000, C=1.0)
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, df: DataFrame):
        wcol = self.getWeightCol() if self.isSet(self.weightCol) else None
        total = df.agg(F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).first()[0] or 1
        lr = LogisticRegression(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                                maxIter=self.getMaxIter(),
                                regParam=1.0 / (self.getOrDefault(self.C) * float(total)),
                                elasticNetParam=0.0, standardization=False)
        if wcol:
            lr.setWeightCol(wcol)
        return lr.fit(df)


def logistic(max_iter: int = 1000, C: float = 1.0, weight_col: str | None = None):
    return SummedLossLogistic(maxIter=max_iter, C=C, weightCol=weight_col)


def random_forest(num_trees: int = 100, max_depth: int = 30, subset: str = "sqrt",
                  seed: int = SEED, weight_col: str | None = None):
    rf = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth,
                                featureSubsetStrategy=subset, seed=seed)
    return rf.setWeightCol(weight_col) if weight_col else rf


def gbt(rounds: int = 100, step: float = 0.3, max_depth: int = 6, subsample: float = 1.0,
        seed: int = SEED, weight_col: str | None = None):
    g = GBTClassifier(maxIter=rounds, stepSize=step, maxDepth=max_depth,
                      subsamplingRate=subsample, lossType="logistic", seed=seed)
    return g.setWeightCol(weight_col) if weight_col else g


def rff_svc(num_features: int = 256, gamma: float | None = None, max_iter: int = 100,
            seed: int = SEED, weight_col: str | None = None):
    rff = RandomFourierFeatures(inputCol="features", outputCol="__rff",
                                numFeatures=num_features, gamma=gamma, seed=seed)
    svc = LinearSVC(featuresCol="__rff", maxIter=max_iter, regParam=0.0)
    if weight_col:
        svc.setWeightCol(weight_col)
    return Pipeline(stages=[rff, svc])


# Sizes per preset: reference = the original settings; small = quick checks.
PRESETS = {
    "reference": dict(lr_iter=1000, rf_trees=100, rf_depth=30, rf2_trees=170, rf2_depth=10,
                      gbt_rounds=100, gbt2_rounds=170, svc_iter=100, rff_dim=256,
                      folds=3, bags=10),
    "small": dict(lr_iter=50, rf_trees=10, rf_depth=5, rf2_trees=10, rf2_depth=5,
                  gbt_rounds=5, gbt2_rounds=5, svc_iter=20, rff_dim=64, folds=2, bags=2),
}


def base_learners(preset: str = "reference", weight_col: str | None = None) -> dict:
    p = PRESETS[preset]
    return {
        "lr": logistic(p["lr_iter"], weight_col=weight_col),
        "rf100": random_forest(p["rf_trees"], p["rf_depth"], "sqrt", weight_col=weight_col),
        "rf170": random_forest(p["rf2_trees"], p["rf2_depth"], "sqrt", weight_col=weight_col),
        "xgb100": gbt(p["gbt_rounds"], 0.3, 6 if preset == "reference" else 3,
                      weight_col=weight_col),
        "xgb170": gbt(p["gbt2_rounds"], 0.1, 6 if preset == "reference" else 3,
                      weight_col=weight_col),
        "svc": rff_svc(p["rff_dim"], max_iter=p["svc_iter"], weight_col=weight_col),
    }


def model_zoo(preset: str = "reference", key_cols=("id",)) -> dict:
    """The sweep of the original scripts (five singles, seven stacks, four bootstrapped singles) and
    the main program's bag of stacks."""
    from tidemark.learn.ensemble import BaggingEstimator, StackingEstimator

    p = PRESETS[preset]

    def b(weight_col=None):
        return base_learners(preset, weight_col)

    def stack(names, meta_iter=100):
        def make(weight_col=None):
            bl = b(weight_col)
            return StackingEstimator({n: bl[n] for n in names},
                                     logistic(meta_iter, weight_col=weight_col),
                                     num_folds=p["folds"], key_cols=key_cols,
                                     weight_col=weight_col)
        return make

    def bag(make_base):
        return BaggingEstimator(make_base, num_models=p["bags"], key_cols=key_cols)

    single = b()
    basic = {"rf": "rf100", "xgb": "xgb100", "lr": "lr", "svc": "svc"}
    advanced = basic | {"rf": "rf170", "xgb": "xgb170"}
    zoo = {
        "LR-1000": single["lr"],
        "RF-100": single["rf100"],
        "RF-170 (10, sqrt)": single["rf170"],
        "XGB-100": single["xgb100"],
        "XGB-170 (0.1, 6)": single["xgb170"],
    }
    for label, kind in (("BASIC", basic), ("ADVANCED", advanced)):
        for names in (("rf", "xgb", "lr", "svc"), ("rf", "xgb", "lr"), ("rf", "xgb")):
            zoo[f"STACK-{label} ({', '.join(names)})"] = stack([kind[n] for n in names])()
    zoo["STACK-HYBRID (rf, xgb, lr)"] = stack(["rf170", "xgb100", "lr"])()
    for label, name in (("RF-100", "rf100"), ("RF-170 (10, sqrt)", "rf170"), ("XGB-100", "xgb100"),
                        ("XGB-170 (0.1, 6)", "xgb170")):
        zoo[f"BOOTSTRAP-{label}"] = bag(lambda w, name=name: b(w)[name])
    zoo["BAG-OF-STACK (rf170, xgb170, lr)"] = bag(stack(["rf170", "xgb170", "lr"]))
    return zoo
