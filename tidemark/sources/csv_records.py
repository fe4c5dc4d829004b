"""Records of CSV files whose quoted fields hold line breaks, read in many tasks a file.

A file is read line by line from all its splits. Within a split the parity of the
quotes before a line is known up to the parity at the split's start; one row a
split (its total parity, and the last line that would start a record in either
case) gives those by a running sum over the file's splits. A line that starts
outside quotes and has an even number of quotes is a record. Only the lines of
the other records are shuffled, to be put together across lines and split ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.io import materialize

HEAD_LINES = 16        # a header may span so many lines
LINES = "file string, block long, line long, before int, odd int, last0 long, last1 long, value string"


def _numbered(lines: DataFrame) -> DataFrame:
    """``LINES``: a line's number in its split, the parity of quotes before it there and its own, and the last
    line up to it that starts a record if the split starts outside (``last0``) or inside (``last1``) quotes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, line, parity, last = None, 0, 0, [-1, -1]
        for b in batches:
            if not b.num_rows:
                continue
            files, blocks = b.column("file"), b.column("block").to_numpy()
            quotes = pc.count_substring(b.column("value"), '"').to_numpy() % 2
            # The rows of a split follow one another; a task may read several splits.
            names = files.dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero(np.append(True, (blocks[1:] != blocks[:-1]) | (names[1:] != names[:-1])))
            for start, end in zip(cuts, np.append(cuts[1:], b.num_rows), strict=True):
                if (at := (files[int(start)].as_py(), int(blocks[start]))) != here:
                    here, line, parity, last = at, 0, 0, [-1, -1]
                n, odd = int(end - start), quotes[start:end]
                total = parity + np.cumsum(odd)
                before = (total - odd) % 2
                number = line + np.arange(n)
                lasts = [np.maximum.accumulate(np.where(before == k, number, last[k])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [files.slice(start, n), b.column("block").slice(start, n), pa.array(number),
                     pa.array(before.astype(np.int32)), pa.array(odd.astype(np.int32)),
                     *[pa.array(v, mask=v < 0) for v in lasts], b.column("value").slice(start, n)],
                    names=[c.split()[0] for c in LINES.split(", ")])
                line, parity, last = line + n, int(total[-1] % 2), [int(v[-1]) for v in lasts]

    return lines.mapInArrow(run, LINES)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _numbered(spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def _records(df: DataFrame) -> DataFrame:
    return (df.where((F.col("block") > 0) | (F.col("line") > 0))
              .withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.col("record") != ""))


def line_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """The same, every line a record."""
    lines = _lines(spark, path).select("file", "block", "line", F.col("value").alias("record"))
    first = lines.where((F.col("block") == 0) & (F.col("line") == 0))
    return _records(lines), first.select("file", _clean_header(F.col("record")).alias("header"))


def csv_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Records ``file, block, line, record`` (block and line of its start) and headers ``file, header``.

    The first record of a file is its header and is left out of the records, as are empty lines. A carriage return
    before a record's end is dropped; line breaks inside quotes are kept.
    """
    numbered = _lines(spark, path)
    head = F.when((F.col("block") == 0) & (F.col("line") < HEAD_LINES), F.struct("line", "value", "odd"))
    splits = materialize(numbered.groupBy("file", "block").agg(
        F.max("last0").alias("last0"), F.max("last1").alias("last1"), (F.sum("odd") % 2).alias("odd"),
        F.sort_array(F.collect_list(head)).alias("head")), "csv-splits")

    # One row a split: the parity at its start, and where the record that is open there began.
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("inside", F.coalesce(F.sum("odd").over(order) % 2, F.lit(0)))
    own = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    starts = starts.withColumn("open", F.last(F.when(own.isNotNull(), F.struct(F.col("block"), own.alias("line"))),
                                              ignorenulls=True).over(order)).select("file", "block", "inside", "open")
    headers = splits.where(F.col("block") == 0).select("file", _first_record("head").alias("header"))

    placed = numbered.join(starts, ["file", "block"])
    begins = F.col("before") == F.col("inside")
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    begun = F.when(last.isNotNull(), F.struct(F.col("block"), last.alias("line"))).otherwise(F.col("open"))
    alone = begins & (F.col("odd") == 0)
    single = placed.where(alone).select("file", "block", "line", F.col("value").alias("record"))
    parts = placed.where(~alone).select("file", begun.alias("at"), F.struct("block", "line", "value").alias("part"))
    joined = (parts.groupBy("file", "at").agg(F.sort_array(F.collect_list("part")).alias("parts"))
              .select("file", "at.block", "at.line", F.concat_ws("\n", F.col("parts.value")).alias("record")))
    return _records(single.unionByName(joined)), headers


def _clean_header(text: Column) -> Column:
    """Without a byte order mark and a carriage return."""
    return F.regexp_replace(text, "^\ufeff|\r$", "")


def _first_record(lines: str) -> Column:
    """The first lines up to the one that closes the quotes, from ``array<struct<line, value, odd>>``."""
    open_ = F.struct(F.lit("").alias("text"), F.lit(1).alias("odd"), F.lit(False).alias("done"))
    step = lambda s, x: F.when(s["done"], s).otherwise(F.struct(
        F.when(x["line"] == 0, x["value"]).otherwise(F.concat(s["text"], F.lit("\n"), x["value"])).alias("text"),
        ((s["odd"] + x["odd"]) % 2).cast("int").alias("odd"), ((s["odd"] + x["odd"]) % 2 == 1).alias("done")))
    return _clean_header(F.aggregate(lines, open_, step, lambda s: F.when(s["done"], s["text"])))
