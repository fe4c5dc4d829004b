"""Adapters from the provided parquet tables to the posts data model.

Posts: ``match_id, period_id, id`` (period keys), ``post_id`` (unique, the
order of posts inside a period), ``text`` and/or ``value``, and the label
``event_type`` (double, NULL when unknown).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Start of the events clock: periods are whole hours / days since this instant.
EVENTS_EPOCH = "2024-01-01 00:00:00"
_US_PER_HOUR = 3_600_000_000
_US_PER_DAY = 86_400_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# A text table with less than this for each core is dealt out before it is worked on.
SPREAD_BYTES = 32 << 20


def text_table(spark: SparkSession, sf_dir: str, name: str, *key: str) -> DataFrame:
    """A table of texts with enough partitions for all cores.

    Work on texts is bound by CPU, and a small table is often one row group,
    that is one task. Tables of less than ``SPREAD_BYTES`` a core are dealt out
    by ``key`` (text moves once); larger ones have splits enough.
    """
    df = read_table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))     # of the listed files
    return df.repartition(cores, *key) if size < cores * SPREAD_BYTES else df


def _period_id(key: F.Column) -> F.Column:
    return F.concat_ws(":", key.cast("string"), F.col("period_id").cast("string"))


def event_posts(spark: SparkSession, sf_dir: str, grouping: str = "type_hour") -> DataFrame:
    """``events`` as text-less posts.

    * ``type_hour``: match = ``event_type``, period = whole hours since epoch.
    * ``user_day``: match = ``user_id``, period = whole days (sparse periods).
    Posts inside a period are ordered by ``(ts, event_id)``; ``post_id`` is
    ``event_id``.
    """
    ev = read_table(spark, sf_dir, "events")
    # Wall-clock difference in the column's own type: no session time zone
    # enters for timestamp_ntz, so buckets do not move with the session.
    ts_type = ev.schema["ts"].dataType.simpleString()
    micros = F.timestamp_diff("MICROSECOND", F.lit(EVENTS_EPOCH).cast(ts_type), F.col("ts"))
    if grouping == "type_hour":
        match, unit = F.col("event_type"), _US_PER_HOUR
    elif grouping == "user_day":
        match, unit = F.col("user_id").cast("string"), _US_PER_DAY
    else:
        raise ValueError(f"unknown grouping {grouping!r}")
    return (ev.select(
                match.alias("match_id"),
                F.floor(micros / F.lit(unit)).cast("long").alias("period_id"),
                F.col("event_id").alias("post_id"),
                F.col("ts"),
                F.col("value").cast("double").alias("value"))
              .withColumn("id", _period_id(F.col("match_id")))
              .withColumn("event_type", F.lit(None).cast("double")))


def document_posts(spark: SparkSession, sf_dir: str, period_size: int = 100,
                   labelled: bool = True) -> DataFrame:
    """``documents`` left join ``labels`` as labelled text posts (``labelled=False``: no join).

    match = ``source``, period = ``doc_id div period_size``, post = document.
    ``event_type`` per post is ``1 - quality`` (NULL when unlabelled); the
    period label is the max over its labelled posts (``label_agg="max"``).
    ``labels`` has at most one row per document, so the join keeps one row
    per document.
    """
    docs = text_table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "lang", "source")
    if labelled:
        docs = docs.join(read_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    else:
        docs = docs.withColumn("quality", F.lit(None).cast("int"))
    return (docs
                .select(
                    F.col("source").alias("match_id"),
                    F.floor(F.col("doc_id") / F.lit(period_size)).cast("long").alias("period_id"),
                    F.col("doc_id").alias("post_id"),
                    F.col("lang"),
                    F.col("text"),
                    (F.lit(1.0) - F.col("quality").cast("double")).alias("event_type"))
                .withColumn("id", _period_id(F.col("match_id"))))


def conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as unlabelled posts: match = ``conv_id``, period = ``turn``."""
    conv = text_table(spark, sf_dir, "conversations", "conv_id", "turn")
    return (conv.select(
                F.col("conv_id").cast("string").alias("match_id"),
                F.col("turn").cast("long").alias("period_id"),
                (F.col("conv_id") * F.lit(1 << 31) + F.col("turn")).alias("post_id"),
                F.col("role"),
                F.col("text"))
              .withColumn("id", _period_id(F.col("match_id")))
              .withColumn("event_type", F.lit(None).cast("double")))
