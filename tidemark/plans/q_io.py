"""Registered queries: post files and checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.learn.fits import Boost, Forest, Logistic
from tidemark.learn.graph import Bag, FittedModels, Single, Stack
from tidemark.operators.periods import period_volume
from tidemark.plans.features import Resources, build_features
from tidemark.plans.registry import query
from tidemark.plans.resources import benchmark_lexicon
from tidemark.plans.training import score, train_models
from tidemark.session import scratch_path
from tidemark.sources.adapters import conversation_posts, event_posts
from tidemark.sources.checkpoints import address, checkpoint, is_done
from tidemark.sources.io import materialize, read_posts, write_predictions


@query("posts_csv_scan", sql="""
SELECT CAST(conv_id AS VARCHAR) AS match_id, turn AS period_id, count(*) AS n_posts,
       sum(length(coalesce(text, ''))) AS n_chars,
       max(CASE WHEN conv_id % 2 = 0 THEN CAST(turn % 2 AS DOUBLE) END) AS event_type
FROM conversations GROUP BY ALL""",
       note="posts written as CSV files with and without EventType and in two column orders, scanned back")
def q_posts_csv_scan(spark, sf_dir):
    """Training files (with ``EventType``) for even conversations, files to score for odd ones."""
    posts = conversation_posts(spark, sf_dir).select(
        F.col("id").alias("ID"), F.col("match_id").alias("MatchID"), F.col("period_id").alias("PeriodID"),
        (F.col("period_id") % 2).cast("double").alias("EventType"), F.col("post_id").alias("Timestamp"),
        F.col("text").alias("Tweet"))
    even = F.col("MatchID").cast("long") % 2 == 0
    path = scratch_path(spark, "posts-csv")
    for part, columns in ((posts.where(even), posts.columns),
                          (posts.where(~even), ["Tweet", "ID", "MatchID", "PeriodID", "Timestamp"])):
        (part.select(*columns).write.mode("append").option("header", True).option("quoteAll", True)
         .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_posts(spark, path).groupBy("match_id", "period_id").agg(
        F.count("*").alias("n_posts"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n_chars"),
        F.max("event_type").alias("event_type"))


@query("posts_csv_split", sql="""
SELECT CAST(conv_id AS VARCHAR) AS match_id, turn AS period_id, count(*) AS n_posts,
       sum(length(coalesce(text, '')) + 9 + length(CAST(turn AS VARCHAR))) AS n_chars,
       sum(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 2) AS n_breaks
FROM conversations GROUP BY ALL""",
       note="one CSV file with quotes and line breaks in its fields, read in as many tasks as it has splits")
def q_posts_csv_split(spark, sf_dir):
    posts = conversation_posts(spark, sf_dir).select(
        F.col("id").alias("ID"), F.col("match_id").alias("MatchID"), F.col("period_id").alias("PeriodID"),
        F.col("post_id").alias("Timestamp"),
        F.concat(F.coalesce("text", F.lit("")), F.lit('\n"q",\n,""'), F.col("period_id").cast("string")).alias("Tweet"))
    path = scratch_path(spark, "posts-one-csv")
    (posts.coalesce(1).write.option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")          # many splits, as a large file has at the usual size
    try:
        found = materialize(read_posts(spark, path).select("match_id", "period_id", "text"), "split-posts")
    finally:
        spark.conf.set(key, before)
    text = F.col("text")
    return found.groupBy("match_id", "period_id").agg(
        F.count("*").alias("n_posts"), F.sum(F.length(text)).alias("n_chars"),
        F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).alias("n_breaks"))


@query("checkpoint_reuse", sql="""
SELECT event_type AS match_id, CAST(floor(epoch(ts) / 3600) - floor(epoch(TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS period_id,
       count(*) AS n_posts, TRUE AS reused, FALSE AS changed_reused
FROM events GROUP BY ALL""",
       note="a checkpoint written by one plan is found by an equal one, and not by one with another parameter")
def q_checkpoint_reuse(spark, sf_dir):
    root = scratch_path(spark, "checkpoints")
    table = lambda: period_volume(event_posts(spark, sf_dir))
    checkpoint(table(), "volume", root, {"feature": "volume"})
    reused = is_done(spark, f"{root}/volume-{address(table(), {'feature': 'volume'})}")
    changed = is_done(spark, f"{root}/volume-{address(table(), {'feature': 'other'})}")
    return checkpoint(table(), "volume", root, {"feature": "volume"}).select(
        "match_id", "period_id", "n_posts", F.lit(reused).alias("reused"), F.lit(changed).alias("changed_reused"))


@query("score_csv_files", sql="""
SELECT DISTINCT event_type || ':' || p AS id, CAST(p % 2 AS DOUBLE) AS event_type
FROM (SELECT event_type, CAST(floor(epoch(ts) / 3600) - floor(epoch(TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS p FROM events)
WHERE event_type IN ('signup', 'view')""",
       note="training files and files to score, features scaled per file, a stack and a bag fitted, saved and loaded, "
       "predictions written in order and read back; posts of odd periods name a key phrase, so the answer is known")
def q_score_csv_files(spark, sf_dir):
    posts = event_posts(spark, sf_dir).select(
        F.col("id").alias("ID"), F.col("match_id").alias("MatchID"), F.col("period_id").alias("PeriodID"),
        (F.col("period_id") % 2).cast("double").alias("EventType"), F.col("post_id").alias("Timestamp"),
        F.when(F.col("period_id") % 2 == 1, F.lit("goal, now\nor never")).otherwise("nothing to see").alias("Tweet"))
    to_score = F.col("MatchID").isin("signup", "view")
    root = scratch_path(spark, "score-files")
    for part, name in ((posts.where(~to_score), "train"), (posts.where(to_score).drop("EventType"), "eval")):
        (part.repartition("MatchID").write.option("header", True).option("quoteAll", True).option("escape", '"')
         .csv(f"{root}/{name}"))
    res = Resources(lexicon=benchmark_lexicon(spark, sf_dir))
    feats = build_features(read_posts(spark, f"{root}/train"), "features_only", res)
    learners = {"stack": Stack((Forest(10, 4), Boost(10, 0.3, 3), Logistic())), "bag": Bag(Single(Boost(5, 0.3, 2)), 3)}
    train_models(feats, "features_only", learners).save(f"{root}/model")
    fitted = FittedModels.load(spark, f"{root}/model")
    # every file scaled by its own maxima, as the original scores them
    evals = build_features(read_posts(spark, f"{root}/eval"), "features_only", res, label_col=None, scale_by="source_file")
    stack, bag = (score(fitted.model(m), evals, "features_only") for m in learners)
    write_predictions(stack.join(bag.withColumnRenamed("event_type", "other"), "id").where("event_type = other"),
                      f"{root}/predictions", sort=True)
    back = spark.read.schema("ID string, EventType double").option("header", True).csv(f"{root}/predictions")
    return back.select(F.col("ID").alias("id"), F.col("EventType").alias("event_type"))
