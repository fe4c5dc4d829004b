import io
from contextlib import redirect_stdout

import pytest

from tidemark.functions.fixed import ENGLISH_STOP_WORDS
from tidemark.plans import catalog  # noqa: F401
from tidemark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
# Queries whose building does not fit models (the learners' plans are ML jobs).
NON_ML = [n for n in sorted(QUERIES) if not n.startswith(("model_", "stack", "bag_of",
                                                          "leaderboard", "predictions_"))]


@pytest.mark.parametrize("name", NON_ML)
def test_no_cartesian_or_nested_loop_join(spark, name):
    df = QUERIES[name].build(spark, SF)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["tokens", "frequency_dictionary", "mean_word_vector", "sentiment_abs_join"])
def test_cleaning_is_evaluated_once(spark, name):
    """The cleaning regex of the documents stands in one operator of the plan (a plain explode would add a
    filter on the array's size with a second evaluation below the projection)."""
    plan = _optimized(QUERIES[name].build(spark, SF))
    for line in plan.splitlines():
        assert not ("Filter" in line and "regexp_replace" in line), line[:200]


def test_vectors_are_joined_after_the_per_word_aggregate(spark):
    from tidemark.operators.embedding import period_word_vector_sum

    df = spark.createDataFrame([("a", 1, ["x", "y", "x"])], "k string, post_id long, tokens array<string>")
    vec = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [0.0, 4.0])], "word string, vec array<double>")
    out = period_word_vector_sum(df, vec, ["k"])
    assert [round(x, 6) for x in out.first()["vec_sum"]] == [0.666667, 2.666667]
    lines = _optimized(out).splitlines()
    deepest = max(i for i, line in enumerate(lines) if "Aggregate" in line and "word" in line)
    vector = min(i for i, line in enumerate(lines) if "array_to_vector" in line or "UDF" in line and "vec" in line)
    assert vector < deepest or "vec#" not in "".join(lines[deepest + 1:deepest + 3])


def test_stop_words_by_join_and_inline(spark):
    from tidemark.operators.text import remove_stopwords

    rows = [(1, ["the", "goal", "of"]), (2, ["the", "of"]), (3, []), (4, None), (5, ["a", "x", "a", "z"])]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "post_id long, tokens array<string>, pos string")
    stop = spark.createDataFrame([(w,) for w in [*ENGLISH_STOP_WORDS, None, "the"]], "w string")
    both = [{r.post_id: list(r.tokens or []) for r in remove_stopwords(df, stop, inline_limit=n).collect()}
            for n in (0, 1000)]
    assert both[0] == both[1] == {1: ["goal"], 2: [], 3: [], 4: [], 5: ["x", "z"]}
    assert remove_stopwords(df, stop, inline_limit=0).columns == df.columns


def test_sentiment_by_join_and_inline(spark):
    from tidemark.operators.sentiment import sentiment_score

    df = spark.createDataFrame([(1, ["good", "bad", "good"]), (2, []), (3, ["none"])],
                               "post_id long, tokens array<string>")
    lex = spark.createDataFrame([("good", 1.0), ("good", 2.0), ("bad", -1.0), (None, 3.0), ("none", None)],
                                "token string, valence double")
    both = [{r.post_id: r.sentiment for r in sentiment_score(df, lex, inline_keys=n).collect()} for n in (0, 1000)]
    s = 2.0
    assert both[0] == both[1] == {1: round(s / (s * s + 15) ** 0.5, 4), 2: 0.0, 3: 0.0}


def test_maximum_of_the_null_group(spark):
    from tidemark.operators import lookup
    from tidemark.operators.periods import max_scale

    df = spark.createDataFrame([("a", 2.0), ("a", 4.0), (None, 5.0), (None, 10.0), ("z", 0.0)], "g string, x double")
    want = [("None", 0.5), ("None", 1.0), ("a", 0.5), ("a", 1.0), ("z", None)]
    for limit in (lookup.DEFAULT_BROADCAST_BYTES, 0):
        got = sorted(((str(r.g), r.x) for r in max_scale(df, "x", by="g").collect()), key=repr)
        assert got == sorted(want, key=repr), limit


def test_broadcast_is_bounded_in_bytes(spark):
    from tidemark.operators.lookup import bounded_bytes

    wide = spark.range(1000).selectExpr("id", "array_repeat(1.0D, 200) AS vec")
    assert bounded_bytes(wide, 1 << 20) is None and bounded_bytes(wide, 1 << 22) > 1_600_000
    assert bounded_bytes(wide.limit(0), 10) == 0 and bounded_bytes(wide, 0) is None


def test_lemmas_to_exhaustion(spark):
    from tidemark.operators.lemma import lemmatize_tokens

    vocab = spark.createDataFrame([("pa",), ("ox",)], "w string")
    toks = spark.createDataFrame([("passs",), ("passss",), ("pa" + "s" * 12,), ("oxes",), ("zz",)], "token string")
    got = {r.token: r.lemma for r in lemmatize_tokens(toks, vocab).collect()}
    assert got == {"passs": "pa", "passss": "pa", "pa" + "s" * 12: "pa", "oxes": "ox", "zz": "zz"}


def test_cleaning_classes_equal_python(spark):
    """The regex classes against Python's ``re`` over all code points that both Unicode versions know
    (Python's own 3.2 database: Java's version lags behind Python's)."""
    import re
    import sys
    import unicodedata

    from tidemark.functions.text import clean_regex, tokenize

    chars = [chr(c) for c in range(1, sys.maxunicode + 1)
             if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cs", "Cn", "Co")]
    df = spark.createDataFrame([(i, f"a{c}b") for i, c in enumerate(chars)], "i int, t string").repartition(8)
    got = {r.i: r.k for r in df.select("i", tokenize(clean_regex("t")).alias("k")).collect()}
    odd = []
    for i, c in enumerate(chars):
        t = re.sub(r"\d+", "", re.sub(r"[^\w\s]", "", f"a{c}b".lower()))
        if got[i] != t.split():
            odd.append(c)
    print(len(odd), [hex(ord(c)) for c in odd])
    assert len(odd) <= 60, odd
    assert not [c for c in odd if ord(c) < 0x250]


def test_nothing_is_left_behind(spark):
    import os

    from tidemark.session import checkpoint_dir, release

    release(spark)
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    for _ in range(2):
        catalog.flagship(spark, SF).collect()
        release(spark)
    assert set(os.listdir(base)) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached


def test_local_fallback_is_refused_on_a_cluster(spark, monkeypatch):
    from tidemark import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_resources_and_partitions_by_need(spark):
    from tidemark.plans.training import document_resources, train_partitions
    from tidemark.sources.adapters import text_table

    assert document_resources(spark, SF, ["features_only", "encoder_only"]).word_vectors is None
    assert document_resources(spark, SF, ["embedding_only"]).word_vectors is not None
    assert [train_partitions(spark.range(n)) for n in (0, 10, 100_000, 120_000)] == [2, 2, 2, 3]
    plan = text_table(spark, SF, "documents", "doc_id").where("lang = 'en'").select("doc_id", "lang")
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_small_sides_are_computed_once(spark):
    """A lexicon's key sets take one job; a group's maximum is written, then counted and joined."""
    from tidemark.operators.lookup import value_sets
    from tidemark.operators.periods import max_scale

    lexicon = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", -2.0), ("d", 0.0), (None, None)], "token string, value double")
    assert value_sets(lexicon, "token", "value") == [(-2.0, ["c"]), (1.0, ["a", "b"])]
    assert value_sets(lexicon, "token", "value", max_keys=2) is None
    assert value_sets(lexicon, "token", "value", max_values=1) is None
    df = spark.createDataFrame([("x", 1.0), ("x", 4.0), ("y", 0.0), (None, 3.0)], "g string, v double")
    plan = _optimized(max_scale(df, "v", by="g", out_col="s"))
    assert "Aggregate" not in plan
    assert sorted((r.g or "", r.s) for r in max_scale(df, "v", by="g", out_col="s").collect() if r.s is not None) == [
        ("", 1.0), ("x", 0.25), ("x", 1.0)]
