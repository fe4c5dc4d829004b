"""Checkpoints that a later run finds again.

A checkpoint's folder is named by what it holds: a digest of the plan, the given
parameters, and the name, size and time of every file the plan reads. A run with
the same three reads what is there; a change of any of them makes another folder.
A folder counts once its commit marker is there: it is written aside and renamed.

A plan's text does not show the code of Python functions nor rows that were made on
the driver, so a plan with either has an address only together with ``params`` that
stand for them.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

MARKER = "_SUCCESS"
_HIDDEN = re.compile(r"Python|Pandas|InArrow|FlatMap|LogicalRDD|LocalRelation|ExternalRDD|EvalPython|monotonically|rand\(|uuid\(")


class NoAddress(ValueError):
    """The plan's text does not say all that it computes."""


def _plan_text(df: DataFrame) -> str:
    """The analysed plan with its column numbers in order of appearance."""
    spark, key = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, str(2**31 - 1))
    try:
        text = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(key, before)
    seen: dict[str, str] = {}
    return re.sub(r"#\d+L?|\b([xyz])_\d+\b", lambda m: seen.setdefault(m.group(), f"#{len(seen)}"), text)


def _files(df: DataFrame) -> list[tuple[str, int, int]]:
    """Name, bytes and time of every file that the plan reads, from one listing a folder."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = sorted(df.inputFiles())
    wanted, out = set(files), []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for s in path.getFileSystem(conf).listStatus(path):
            name = s.getPath().toUri().toString()
            if name in wanted or name.replace("file:/", "file:///", 1) in wanted:
                out.append((name, s.getLen(), s.getModificationTime()))
    if len(out) < len(wanted):
        raise NoAddress(f"{len(wanted) - len(out)} input files are not listed")
    return sorted(out)


def address(df: DataFrame, params=None) -> str:
    """The digest that names a checkpoint of ``df``; :class:`NoAddress` if the plan hides something and ``params`` is None."""
    plan = _plan_text(df)
    if params is None and (hidden := _HIDDEN.search(plan)):
        raise NoAddress(f"the plan has {hidden.group()}: give params that tell what it computes")
    what = json.dumps([plan, params, _files(df), df.schema.json()], sort_keys=True, default=str)
    return hashlib.sha256(what.encode()).hexdigest()[:32]


def _paths(spark: SparkSession, *paths: str):
    made = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return made[0].getFileSystem(spark._jsc.hadoopConfiguration()), *made


def is_done(spark: SparkSession, path: str) -> bool:
    fs, marker = _paths(spark, f"{path}/{MARKER}")
    return fs.exists(marker)


def checkpoint(df: DataFrame, name: str, root: str, params=None) -> DataFrame:
    """``df`` as a table under ``root``: read if a run with the same plan, parameters and files has written it.

    ``root`` is a folder that the driver and all executors share. ``params`` (JSON values) are part of the address; they
    must tell what Python functions in the plan compute. Nothing is deleted: see :func:`forget`.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}-{address(df, params)}"
    if not is_done(spark, path):
        aside = f"{root.rstrip('/')}/.{name}-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        fs, source, target = _paths(spark, aside, path)
        if fs.exists(target) and not is_done(spark, path):
            fs.delete(target, True)          # left by another way of writing, without its marker
        if not fs.rename(source, target) or not is_done(spark, path):
            raise OSError(f"cannot put {aside} at {path}")
        _drop_inner(spark, path, aside)
    return spark.read.schema(df.schema).parquet(path)


def _drop_inner(spark: SparkSession, path: str, aside: str) -> None:
    """Two runs at once: a rename onto a folder that is there by now puts ours inside it. Remove that copy."""
    fs, inner = _paths(spark, f"{path}/{aside.rsplit('/', 1)[1]}")
    if fs.exists(inner):
        fs.delete(inner, True)


def forget(spark: SparkSession, root: str, name: str) -> int:
    """Delete all checkpoints of a name; returns how many."""
    fs, pattern = _paths(spark, f"{root.rstrip('/')}/{name}-*")
    found = fs.globStatus(pattern) or []
    for s in found:
        fs.delete(s.getPath(), True)
    return len(found)
