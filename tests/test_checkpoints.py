import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.sources.checkpoints import NoAddress, address, checkpoint, forget, is_done
from tidemark.sources.io import materialize


def _input(spark, path, n=50):
    spark.range(n).withColumn("v", F.col("id") % 7).coalesce(2).write.mode("overwrite").parquet(path)
    return lambda: spark.read.parquet(path).groupBy("v").agg(F.count("*").alias("n"), F.sum("id").alias("s"))


def _folders(root):
    return sorted(f for f in os.listdir(root) if not f.startswith("."))


def test_found_again_and_not_when_changed(spark, tmp_path):
    root, src = str(tmp_path / "ck"), str(tmp_path / "in")
    plan = _input(spark, src)
    first = checkpoint(plan(), "agg", root)
    stamp = {f: os.stat(f"{root}/{f}/_SUCCESS").st_mtime_ns for f in _folders(root)}
    again = checkpoint(plan(), "agg", root)
    assert sorted(first.collect()) == sorted(again.collect()) == sorted(plan().collect())
    assert stamp == {f: os.stat(f"{root}/{f}/_SUCCESS").st_mtime_ns for f in _folders(root)} and len(stamp) == 1
    checkpoint(plan().where("n > 3"), "agg", root)                # another plan
    checkpoint(plan(), "agg", root, {"dim": 3})                   # another parameter
    assert len(_folders(root)) == 3
    time.sleep(0.01)
    changed = _input(spark, src, 60)                               # other files
    assert checkpoint(changed(), "agg", root).agg(F.sum("n")).first()[0] == 60
    assert len(_folders(root)) == 4
    assert forget(spark, root, "agg") == 4 and not _folders(root)


def test_an_unfinished_folder_is_written_anew(spark, tmp_path):
    root = str(tmp_path / "ck")
    plan = _input(spark, str(tmp_path / "in"))
    path = f"{root}/agg-{address(plan())}"
    checkpoint(plan(), "agg", root)
    os.remove(f"{path}/_SUCCESS")
    for f in os.listdir(path):
        if f.startswith("part-"):
            os.remove(f"{path}/{f}")
    assert not is_done(spark, path)
    assert sorted(checkpoint(plan(), "agg", root).collect()) == sorted(plan().collect()) and is_done(spark, path)
    assert not [f for f in os.listdir(root) if f.startswith(".agg") and not f.endswith(".crc")]


def test_hidden_code_and_rows_need_params(spark, tmp_path):
    plan = _input(spark, str(tmp_path / "in"))
    coded = plan().mapInArrow(lambda it: it, plan().schema)
    made = spark.createDataFrame([(1,)], "a int")
    for df in (coded, made, plan().withColumn("r", F.rand())):
        with pytest.raises(NoAddress):
            address(df)
        assert address(df, ["v1"]) != address(df, ["v2"])
    assert address(coded, ["v1"]) == address(plan().mapInArrow(lambda it: it, plan().schema), ["v1"])


def test_materialize_keeps_what_has_an_address(spark, tmp_path):
    root = str(tmp_path / "kept")
    plan = _input(spark, str(tmp_path / "in"))
    spark.conf.set("tidemark.checkpoints", root)
    try:
        a, b = materialize(plan(), "x"), materialize(plan(), "x")
        assert a.inputFiles() == b.inputFiles() and len(_folders(root)) == 1
        assert materialize(spark.createDataFrame([(1,)], "a int"), "y").count() == 1 and len(_folders(root)) == 1
        # a table built on a kept one has an address too
        materialize(a.where("n > 3"), "z")
        materialize(b.where("n > 3"), "z")
        assert len(_folders(root)) == 2
    finally:
        spark.conf.unset("tidemark.checkpoints")
    assert materialize(plan(), "x").inputFiles() != a.inputFiles()


def test_materialize_with_python_needs_addresses_of_its_parts(spark, tmp_path):
    root = str(tmp_path / "kept")
    plan = _input(spark, str(tmp_path / "in"))
    made = spark.createDataFrame([(1,)], "a int")
    spark.conf.set("tidemark.checkpoints", root)
    try:
        for params, parts, folders in ((None, [], 0), (["v1"], [plan(), made], 0), (["v1"], [plan()], 1), (["v2"], [plan()], 2)):
            coded = plan().mapInArrow(lambda it: it, plan().schema)
            assert materialize(coded, "x", params=params, parts=parts).count() == plan().count()
            assert (len(_folders(root)) if os.path.isdir(root) else 0) == folders
    finally:
        spark.conf.unset("tidemark.checkpoints")
