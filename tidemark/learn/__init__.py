"""pyspark.ml estimators and ensembles for period classification."""

from tidemark.learn.ensemble import BaggingEstimator, StackingEstimator, bagged_vote
from tidemark.learn.estimators import (
    SummedLossLogistic,
    gbt,
    logistic,
    model_zoo,
    random_forest,
    rff_svc,
)
from tidemark.learn.evaluate import accuracy, leaderboard, positive_score
from tidemark.learn.rff import RandomFourierFeatures

__all__ = [
    "SummedLossLogistic", "logistic", "random_forest", "gbt", "rff_svc", "model_zoo",
    "RandomFourierFeatures", "StackingEstimator", "BaggingEstimator", "bagged_vote",
    "accuracy", "leaderboard", "positive_score",
]
