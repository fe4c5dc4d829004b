import os
import tempfile

import pytest
from pyspark.ml.functions import array_to_vector

from tidemark.learn.estimators import logistic
from tidemark.plans.features import Resources
from tidemark.streaming import start_scoring_stream


HEADER = "ID,MatchID,PeriodID,Timestamp,Tweet\n"


def _model(spark):
    train = spark.createDataFrame(
        [([float(i % 3), float(i % 2), float(i % 5) / 5], float(i % 2)) for i in range(40)],
        "f array<double>, label double").select(array_to_vector("f").alias("features"), "label")
    return logistic(50).fit(train)


def _start(spark, d, model, **options):
    lex = spark.createDataFrame([("goal", 2.0), ("penalty", -1.0)], "token string, valence double")
    q = start_scoring_stream(spark, os.path.join(d, "in"), os.path.join(d, "out"), model, "features_only",
                             Resources(lexicon=lex), os.path.join(d, "ckpt"), **options)
    q.awaitTermination(300)
    return q


def _write(d, name, text):
    os.makedirs(os.path.join(d, "in"), exist_ok=True)
    with open(os.path.join(d, "in", name), "w") as f:
        f.write(text)


def test_scoring_stream_scores_every_file_once(spark):
    d = tempfile.mkdtemp(prefix="tidemark-stream-")
    _write(d, "A.csv", HEADER + "".join(f"1_{p},1,{p},{p * 10 + k},goal match {k}\n"
                                        for p in range(3) for k in range(p + 1)))
    _write(d, "B.csv", HEADER + "2_0,2,0,5,\"penalty\nkick\"\n2_1,2,1,6,red card\n")
    model = _model(spark)
    _start(spark, d, model, max_files=1)
    out = os.path.join(d, "out")
    ids = lambda: sorted(r.ID for r in spark.read.option("header", True).csv(out).collect())
    assert ids() == ["1_0", "1_1", "1_2", "2_0", "2_1"]
    assert spark.read.option("header", True).csv(out).select("batch_id").distinct().count() == 2
    # a restart scores nothing twice, and goes on with a new file
    _start(spark, d, model, max_files=1)
    assert len(ids()) == 5
    _write(d, "C.csv", HEADER + "3_0,3,0,5,late\n")
    _start(spark, d, model, max_files=1)
    assert ids() == ["1_0", "1_1", "1_2", "2_0", "2_1", "3_0"]


def test_another_header_fails_instead_of_shifting(spark):
    d = tempfile.mkdtemp(prefix="tidemark-stream-")
    _write(d, "A.csv", "ID,MatchID,PeriodID,EventType,Timestamp,Tweet\n1_0,1,0,,5,goal\n")
    with pytest.raises(Exception, match="(?i)header|malformed|schema"):
        _start(spark, d, _model(spark))


def test_maxima_of_training_scale_the_stream(spark):
    d = tempfile.mkdtemp(prefix="tidemark-stream-")
    _write(d, "A.csv", HEADER + "1_0,1,0,5,goal\n1_1,1,1,6,red card\n")
    _start(spark, d, _model(spark), maxima={"n_posts": 10.0, "max_phrase_hits": 4.0})
    assert spark.read.option("header", True).csv(os.path.join(d, "out")).count() == 2
