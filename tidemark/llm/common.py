"""Helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Rows per Arrow batch handed to Python: a batch of the longest texts seen
# (about 120 kB) stays near 60 MB.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of Python workers: texts may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
                schema: str) -> DataFrame:
    """``mapInArrow`` over dicts of Python lists; ``fn`` sees a whole partition as an iterator."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_struct(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for out in fn(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def stretches(texts: list[str | None], letters: int = 4_000_000) -> Iterator[slice]:
    """Cut a batch so that a stretch has about ``letters`` letters at most (a longer text is one alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size + n > letters and i > start:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def _struct(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def fold(id_value: int | None, mod: int) -> int:
    """crc32 of the id written as text, modulo ``mod`` (null: the empty text)."""
    return zlib.crc32(b"" if id_value is None else str(id_value).encode()) % mod


def fold_col(id_col: Column | str, mod: int) -> Column:
    """The same as :func:`fold` as a Column."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x20\\x09-\\x0D]+`` as UTF-8.

    ``bytes.lower`` and ``bytes.split`` treat ASCII alone, which is exactly
    this definition.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
