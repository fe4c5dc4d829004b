"""Random Fourier features (Rahimi & Recht, 2007): an explicit map whose dot
products approximate the RBF kernel exp(-gamma * |x - y|^2), so a linear SVM
on it approximates the kernel SVM.

z(x) = sqrt(2 / D) * cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi).
``gamma=None`` uses 1 / (d * Var(X)) over all feature values (computed with
one distributed aggregate at fit time).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _RFFParams(HasInputCol, HasOutputCol, HasSeed):
    numFeatures = Param(Params._dummy(), "numFeatures", "output dimension D",
                        typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "RBF gamma; None = 1/(d Var(X))",
                  typeConverter=TypeConverters.toFloat)


class RandomFourierFeatures(Estimator, _RFFParams):
    @keyword_only
    def __init__(self, inputCol="features", outputCol="rff", numFeatures=256, gamma=None,
                 seed=42):
        super().__init__()
        self._setDefault(numFeatures=256, seed=42)
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> "RandomFourierFeaturesModel":
        col = self.getInputCol()
        arr = vector_to_array(F.col(col), "float64")
        d = df.select(F.size(arr)).first()[0]
        if self.isDefined(self.gamma) and self.isSet(self.gamma):
            gamma = self.getOrDefault(self.gamma)
        else:
            # Variance over all feature values from per-row sums (no explode).
            s1 = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
            s2 = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x * x)
            r = df.agg(F.sum(s1).alias("s1"), F.sum(s2).alias("s2"),
                       F.sum(F.size(arr)).alias("n")).first()
            n = float(r["n"] or 0)
            var = (r["s2"] / n - (r["s1"] / n) ** 2) if n else 0.0
            gamma = 1.0 / (d * var) if var > 0 else 1.0
        rng = np.random.default_rng(self.getSeed())
        D = self.getOrDefault(self.numFeatures)
        w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(d, D))
        b = rng.uniform(0.0, 2.0 * np.pi, size=D)
        return RandomFourierFeaturesModel(col, self.getOutputCol(), w, b)


class RandomFourierFeaturesModel(Model):
    def __init__(self, inputCol: str, outputCol: str, w: np.ndarray, b: np.ndarray):
        super().__init__()
        self.inputCol, self.outputCol, self.w, self.b = inputCol, outputCol, w, b

    def _transform(self, df: DataFrame) -> DataFrame:
        w, b = self.w, self.b
        scale = np.sqrt(2.0 / w.shape[1])

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def rff(xs: pd.Series) -> pd.Series:
            if len(xs) == 0:
                return pd.Series([], dtype=object)
            x = np.stack(xs.to_numpy())
            z = scale * np.cos(x @ w + b)
            return pd.Series(list(z))

        arr = vector_to_array(F.col(self.inputCol), "float64")
        return df.withColumn(self.outputCol, array_to_vector(rff(arr)))
