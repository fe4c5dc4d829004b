"""A training-corpus pipeline over ``documents``: language ID, near-duplicate
removal, personal data, mixing of sources, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``. All stages but the last return the columns of
``documents`` (and any others that were there), with ``n_chars`` brought up to
date where a text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, neardup, packing, pii
from tidemark.llm.common import documents, written
from tidemark.session import ship_package


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is determined; null, empty and letterless texts go, and those
    whose best language has a posterior below 0.5."""
    ship_package(spark)
    return langid.keep_identified(docs, langid.fit(langid.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one with the lowest id."""
    ship_package(spark)
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in the texts replaced by surrogates."""
    ship_package(spark)
    return _recounted(pii.with_surrogates(docs).select(*[F.col(f"`{c}`") for c in docs.columns]))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes; the copy on a source's cut is shortened."""
    return _recounted(mixing.mixed_rows(docs))


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a sequence."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing_sources),
    ("packing", packing_sequences),
]

# Packing needs a tokenizer, language ID a model: SQL cannot express them. Each
# stage is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
