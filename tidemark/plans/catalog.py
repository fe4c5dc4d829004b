"""Imports every query module so that all queries are registered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import q_features, q_io, q_models, q_periods, q_text, q_vectors  # noqa: F401
from tidemark.plans.training import flagship as _flagship


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagship(spark, sf_dir)
