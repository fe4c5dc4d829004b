"""Mixing sources to target weights (native: DataFrame functions only).

Every document gets a hash-random key. Within a source the keys are cut into
ranges of about ``bucket_rows`` documents, so a hot source is spread over many
tasks; sums per range, their prefix sums, and a running sum inside each range
give each document's place in its source's random order. The source's budget
is cut at exactly its word: whole epochs first, then one more pass up to the
budget, the document on the cut giving a part of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
# Weights dealt in turn to the sources in code point order (null last).
WEIGHTS = (3, 1, 2)
SHARE = 1.5          # of all words, to share out
MAX_REPEAT = 2.0     # a source gives its words at most so often
BUCKET_ROWS = 2_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_col: Column) -> Column:
    """60 hash-random bits of the id (null: the empty text)."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, source_rows)`` with each source's ``target``.

    Water level: targets are ``level * weight`` up to ``max_repeat`` times the
    source; the level is found in one pass over the sources sorted by the
    level at which they fill up. One narrow row per source goes through one
    task, which bounds nothing but the number of sources.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                     % len(weights) + 1).cast("double")
    out = sources.withColumn("w", w).withColumn("cap", F.col("source_size") * float(max_repeat))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    out = (out.withColumn("total", F.sum("source_size").over(everything) * float(share))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / F.sum("w").over(after)))
    full = F.col("cap") / F.col("w") <= F.col("level")
    out = (out.withColumn("left", F.col("total") - F.coalesce(
        F.sum(F.when(full, F.col("cap"))).over(everything), F.lit(0.0)))
        .withColumn("w_left", F.sum(F.when(~full, F.col("w"))).over(everything)))
    target = F.when(full, F.col("cap")).otherwise(F.col("left") / F.col("w_left") * F.col("w"))
    return out.select("source", "source_size", "source_rows", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        max_repeat: float = MAX_REPEAT, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", keep_row: bool = True) -> DataFrame:
    """How many words of each document a mix with the given weights takes.

    Returns one row per document: ``row`` (a struct of all its columns, if
    ``keep_row``), ``doc_id``, ``size``, ``source_size``, ``target`` (of its
    source), ``taken`` (words, repeats counted).

    Null text: size 0, nothing taken. Null source: a source of its own, last.
    Null ids share one key and are told apart by their text. Repeated rows are
    separate documents; equal rows are interchangeable, so reruns agree as
    tables. Empty table: no rows. Input columns of any name are safe inside
    ``row``.
    """
    base = docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_row else []),
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), random_key(F.col(id_col)).alias("key"),
        F.xxhash64(F.col(text_col)).alias("tie"))
    narrow = written(base.select("doc_id", "source", "size", "key", "tie"), "mix-sizes")
    if not keep_row:
        base = narrow
    targets = source_targets(narrow.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), weights, share, max_repeat)
    targets = targets.withColumn("buckets", F.ceil(F.col("source_rows") / bucket_rows).cast("long"))
    # Ranges of the key: 2**60 keys cut into ``buckets`` equal parts.
    bucket = F.floor(F.col("key") / F.lit(float(1 << 60)) * F.col("buckets")).cast("long")
    same = F.expr("source <=> t_source")
    t = targets.withColumnRenamed("source", "t_source")
    ranges = (narrow.join(t.select("t_source", "buckets"), same).withColumn("bucket", bucket)
              .groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("r_source"), F.col("bucket").alias("r_bucket"),
                           F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    running = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "tie")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (base.join(t, same).withColumn("bucket", bucket)
           .join(ranges, F.expr("source <=> r_source AND bucket = r_bucket"))
           .withColumn("start", F.col("base") + F.sum("size").over(running) - F.col("size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - epochs * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return out.select(*(["row"] if keep_row else []), "doc_id", "size", "source_size", "target",
                      (epochs * F.col("size") + part).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: one row per copy taken;
    the copy on a source's cut holds the first words of its text."""
    text_col = options.get("text_col", "text")
    out = mix(docs, **options).where(F.col("taken") > 0)
    left = F.col("taken") - F.col("copy") * F.col("size")
    out = out.withColumn("copy", F.explode(F.sequence(
        F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int"))))
    text = F.col(f"row.`{text_col}`")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), 0),
                                F.lit(1), left.cast("int")), "")
    cut = F.when(left >= F.col("size"), text).otherwise(head)
    return out.select(*[(cut if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
