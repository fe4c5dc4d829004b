"""Score a folder of post files with a fitted model, as files arrive.

The original scoring loop reads every evaluation file, builds its period
features (maxima for scaling taken *per file*), predicts and appends the
``ID, EventType`` rows. Here the folder is a streaming file source; each
micro-batch runs the same batch feature plan with ``scale_by="source_file"``
and the fitted model, and writes its predictions to ``out/batch_id=N``,
replacing what an interrupted attempt of the same batch left. Progress lives
in the given checkpoint folder, so a restarted query resumes without scoring
a file twice; every file's posts land in one micro-batch
(``maxFilesPerTrigger`` counts whole files), so per-file maxima are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.features import Resources, assemble, build_features
from tidemark.sources.io import SCORE_CSV_COLUMNS, header_schema, named_posts


def _posts_stream(spark: SparkSession, path: str, columns: Sequence[str], max_files: int) -> DataFrame:
    return named_posts(
        spark.readStream.schema(header_schema(list(columns))).option("header", True)
        .option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", True)
        .option("escape", '"').option("maxFilesPerTrigger", max_files).csv(path))


def start_scoring_stream(spark: SparkSession, in_path: str, out_path: str, model,
                         config: str, res: Resources, checkpoint: str,
                         columns: Sequence[str] = SCORE_CSV_COLUMNS, max_files: int = 16,
                         available_now: bool = True, maxima: dict[str, float] | None = None) -> StreamingQuery:
    """Start the query; ``available_now`` processes what is there and stops.

    ``checkpoint``: the query's own folder; start it again with the same one
    to go on. ``columns``: the files' header; a file with another one fails
    the query instead of being read by position. ``maxima``: scale by these
    (fitted in training) instead of each file's own.
    """
    def score_batch(batch: DataFrame, batch_id: int) -> None:
        # post_id must be unique inside the batch (duplicate posts are
        # possible); it never leaves the batch, so stability across a replay
        # does not matter - the predictions depend only on period keys.
        posts = batch.withColumn("post_id", F.monotonically_increasing_id())
        held: list[DataFrame] = []
        try:
            feats = build_features(posts, config, res, scale_by="source_file", label_col=None,
                                   persisted=held, maxima=maxima)
            data = assemble(feats, config, label_col="__none__")
            pred = model.transform(data).select(
                F.col("id").alias("ID"), F.col("prediction").alias("EventType"))
            pred.write.mode("overwrite").option("header", True).csv(f"{out_path}/batch_id={batch_id}")
        finally:
            for frame in held:          # release this batch's cached frames
                frame.unpersist()

    writer = (_posts_stream(spark, in_path, columns, max_files).writeStream
              .foreachBatch(score_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()
