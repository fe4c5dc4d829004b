"""File sources and sinks."""

from __future__ import annotations

import csv
import io
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path
from tidemark.sources.checkpoints import NoAddress, address, checkpoint

# Columns of post files; a file to score has no ``EventType``, and files may
# have their columns in any order.
POSTS_CSV_SCHEMA = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("MatchID", T.StringType()),
    T.StructField("PeriodID", T.LongType()),
    T.StructField("EventType", T.DoubleType()),
    T.StructField("Timestamp", T.LongType()),
    T.StructField("Tweet", T.StringType()),
])
# What a file to score has, in its order.
SCORE_CSV_COLUMNS = ("ID", "MatchID", "PeriodID", "Timestamp", "Tweet")

_RENAMES = {"ID": "id", "MatchID": "match_id", "PeriodID": "period_id",
            "EventType": "event_type", "Timestamp": "ts", "Tweet": "text"}


def header_schema(header: list[str], schema: T.StructType = POSTS_CSV_SCHEMA) -> T.StructType:
    """The schema of a file with this header: known columns typed, others read as text."""
    known = {f.name: f for f in schema.fields}
    return T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])


def named_posts(df: DataFrame, schema: T.StructType = POSTS_CSV_SCHEMA) -> DataFrame:
    """Post columns by their library names; those a file lacks are NULL, others are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                       .alias(_RENAMES.get(f.name, f.name)) for f in schema.fields],
                     F.col("_metadata.file_name").alias("source_file"))


def read_posts(spark: SparkSession, path: str, schema: T.StructType = POSTS_CSV_SCHEMA,
               multi_line: bool = True) -> DataFrame:
    """Scan a folder of post CSVs into one posts table.

    Files are grouped by their header and each group is read with the types
    of its own columns; so files without ``EventType`` (files to score) and
    files with another column order can be mixed. A missing column is NULL.
    Quoted fields may span lines, and a file is read in as many tasks as it
    has splits (:mod:`tidemark.sources.csv_records`); ``multi_line=False``
    saves a pass over the files if no field holds a line break. A record that
    does not fit its header's columns fails the scan. Each row keeps its
    ``source_file`` so a per-file step is a grouping key, not a loop over
    files. ``post_id`` is unique per row; it is derived at scan time, so
    materialise the result (``materialize``) before using it across several
    jobs. What reaches the driver is the distinct headers.
    """
    from tidemark.sources.csv_records import csv_records, line_records

    records, headers = (csv_records if multi_line else line_records)(spark, path)
    out = None
    for row in headers.select("header").distinct().orderBy("header").collect():
        if row.header is None:
            raise ValueError(f"a file in {path} has no header")
        of = header_schema(next(csv.reader(io.StringIO(row.header)), []), schema)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in of.fields)
        files = headers.where(F.col("header") == row.header).select("file")
        name = F.url_decode(F.replace(F.regexp_extract("file", "([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
        part = records.join(files, "file").select(
            F.from_csv("record", ddl, {"mode": "FAILFAST", "escape": '"'}).alias("fields"), name.alias("source_file"))
        have = {f.name for f in of.fields}
        part = part.select(*[(F.col(f"fields.`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType)
                             .alias(_RENAMES.get(f.name, f.name)) for f in schema.fields], "source_file")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"no post files in {path}")
    return out.withColumn("post_id", F.monotonically_increasing_id())


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite",
                      sort: bool = False) -> None:
    """``ID,EventType`` CSV (S5); one part file per task, no driver gather.

    ``sort=True`` writes the rows in key order (O1) through a range
    partitioning, so part files concatenate in order.
    """
    out = df.select(F.col("id").alias("ID"), F.col("event_type").alias("EventType"))
    if sort:
        out = out.repartitionByRange("ID").sortWithinPartitions("ID")
    out.write.mode(mode).option("header", True).csv(path)


def read_frequency_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``term count`` lines, space separated."""
    return (spark.read.schema("term string, cnt long").option("sep", " ").csv(path)
            .where(F.col("term").isNotNull() & F.col("cnt").isNotNull()))


def read_word_vectors(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """Text word vectors ``word v1 ... vd`` (S7) -> ``word string, vec array<double>``.

    With ``dim``, lines of another width are left out; they are counted and a
    warning tells how many.
    """
    parts = F.split(F.col("value"), " ")
    vec = F.slice(parts, 2, F.size(parts) - 1).cast("array<double>")
    out = spark.read.text(path).select(F.element_at(parts, 1).alias("word"), vec.alias("vec"))
    if dim is not None:
        odd = out.where(F.size("vec") != dim).count()
        if odd:
            warnings.warn(f"{path}: {odd} lines are not of {dim} numbers and are left out", stacklevel=2)
        out = out.where(F.size("vec") == dim)
    return out


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """``token lemma`` lines, separated by white space."""
    return _two_columns(spark, path, "lemma", "string")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``token valence`` lines, separated by a tab or space; further fields are ignored."""
    return _two_columns(spark, path, "valence", "double")


def _two_columns(spark: SparkSession, path: str, second: str, kind: str) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    value = F.get(parts, F.lit(1))
    return (spark.read.text(path)
            .select(F.get(parts, F.lit(0)).alias("token"),
                    value.try_cast(kind).alias(second))
            .where((F.col("token") != "") & F.col(second).isNotNull()))


def read_terms(spark: SparkSession, path: str, col: str = "token") -> DataFrame:
    """One term per line (stop list, lemma vocabulary)."""
    return (spark.read.text(path).select(F.trim("value").alias(col))
            .where(F.col(col) != "").distinct())


def materialize(df: DataFrame, name: str, spark: SparkSession | None = None, params=None,
                parts: Sequence[DataFrame] = ()) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back (S3/S4): cuts lineage, survives executor loss, keeps NULL vs ''.

    With the session setting ``tidemark.checkpoints`` (a shared folder) a table
    whose plan has an address is kept there and found again by later runs
    (:mod:`tidemark.sources.checkpoints`). ``params`` stand for the Python
    functions that ``df`` applies to ``parts``, which must have addresses.
    """
    spark = spark or df.sparkSession
    root = spark.conf.get("tidemark.checkpoints", None)
    if root:
        try:
            return checkpoint(df, name, root, None if params is None else [params, [address(p) for p in parts]])
        except NoAddress:
            pass
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
