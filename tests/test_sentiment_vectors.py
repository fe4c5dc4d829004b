import math

from pyspark.sql import functions as F

from tidemark.operators.embedding import mean_word_vector, period_mean_vector
from tidemark.operators.sentiment import sentiment_score


def _posts(spark):
    return spark.createDataFrame(
        [(0, ["good", "good", "bad"]), (1, ["meh"]), (2, []), (3, ["great", "x", "bad"])],
        "post_id long, tokens array<string>")


def _lexicon(spark):
    return spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("great", 3.1)],
                                 "token string, valence double")


def test_sentiment_hash_sets_equal_join(spark):
    a = {r.post_id: r.sentiment for r in sentiment_score(_posts(spark), _lexicon(spark)).collect()}
    b = {r.post_id: r.sentiment for r in
         sentiment_score(_posts(spark), _lexicon(spark), inline_keys=0).collect()}
    assert a == b
    s = 1.9 + 1.9 - 2.5
    assert a[0] == round(abs(s / math.sqrt(s * s + 15)), 4)
    assert a[1] == 0.0 and a[2] == 0.0


def test_sentiment_rules_by_hand(spark):
    from tidemark.operators.sentiment import SentimentRules
    rules = SentimentRules(spark.createDataFrame([("very", 0.293), ("barely", -0.293)], "token string, weight double"),
                           spark.createDataFrame([("not",), ("not",)], "token string"),
                           spark.createDataFrame([("but",)], "token string"))
    cases = {
        "good": 1.9, "very good": 1.9 + 0.293, "very x good": 1.9 + 0.293 * 0.95, "very x y good": 1.9 + 0.293 * 0.9,
        "very x y z good": 1.9, "barely good": 1.9 - 0.293, "very bad": -2.5 - 0.293, "not good": -0.74 * 1.9,
        "not x y bad": -0.74 * -2.5, "not x y z bad": -2.5, "not very good": (1.9 + 0.293) * -0.74,
        "not not good": 0.74 * 0.74 * 1.9, "good but bad": 0.5 * 1.9 - 1.5 * 2.5, "good but bad but good": 0.5 * 1.9 + 1.5 * (1.9 - 2.5),
        "but": 0.0, "": 0.0, "good very": 1.9}
    df = spark.createDataFrame([(i, t.split()) for i, t in enumerate(cases)] + [(99, None)], "post_id long, tokens array<string>")
    for keys in (50_000, 0):
        got = {r.post_id: r.sentiment for r in
               sentiment_score(df, _lexicon(spark), rules=rules, inline_keys=keys, absolute=False).collect()}
        for i, (text, s) in enumerate(cases.items()):
            assert abs(got[i] - round(s / math.sqrt(s * s + 15), 4)) < 1e-9, text
        assert got[99] == 0.0
    plain = sentiment_score(df, _lexicon(spark), absolute=False).drop("tokens")
    none = sentiment_score(df, _lexicon(spark), rules=SentimentRules(), absolute=False).drop("tokens")
    assert sorted(plain.collect()) == sorted(none.collect())


def test_mean_word_vector_with_zero_default(spark):
    vecs = spark.createDataFrame([("good", [1.0, 0.0]), ("bad", [0.0, 2.0])],
                                 "word string, vec array<double>")
    out = {r.post_id: r.vec for r in mean_word_vector(_posts(spark), vecs, 2).collect()}
    assert out[0] == [2 / 3, 2 / 3]       # multiplicity counts: good, good, bad
    assert out[1] == [0.0, 0.0] and out[2] == [0.0, 0.0]
    assert out[3] == [0.0, 2.0]


def test_period_mean_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 5.0])],
                               "label int, vec array<double>")
    out = {r.label: (r.n_posts, r.vec) for r in period_mean_vector(df, ["label"], "vec").collect()}
    assert out == {1: (2, [2.0, 3.0]), 2: (1, [5.0, 5.0])}


def test_word_vectors_broadcast_in_part_equal_a_plain_loop(spark):
    """However few of the vectors are broadcast, posts and periods get the same sums, and tasks add up a post's vectors
    before any is sent."""
    from tidemark.operators.embedding import period_word_vector_sum, post_vectors

    posts = [("a", 1, ["x", "y", "x", None]), ("a", 2, ["z", "u"]), ("a", 3, []), ("b", 4, ["u"]), (None, 5, ["x"] * 5),
             ("b", 6, ["y", "w", "x"]), ("b", 6, ["z"]), ("b", None, ["x", "z"]), ("c", 7, None)]
    df = spark.createDataFrame(posts, "k string, post_id long, tokens array<string>")
    table = {"x": [1.0, 2.0], "y": [0.0, 4.0], "z": [-1.0, 0.5], "w": [3.0, 3.0]}
    vec = spark.createDataFrame([*table.items(), (None, [9.0, 9.0]), ("u", None)], "word string, vec array<float>")
    want_posts, want_periods = {}, {}
    for k, post, tokens in posts:
        for t in tokens or []:
            if t in table:
                want_posts.setdefault((k, post), []).append(table[t])
    for key, vs in want_posts.items():
        want_posts[key] = [sum(c) / len(vs) for c in zip(*vs, strict=True)]
        want_periods.setdefault(key[0], []).append(want_posts[key])
    want_periods = {k: [sum(c) for c in zip(*vs, strict=True)] for k, vs in want_periods.items()}
    for limit in (0, 150, 1 << 20):
        by_post = post_vectors(df, vec, ["k", "post_id"], limit=limit)
        by_period = period_word_vector_sum(df, vec, ["k"], limit=limit)
        assert "ObjectHashAggregate" not in by_post._jdf.queryExecution().executedPlan().toString()
        got = {(r.k, r.post_id): [round(x, 9) for x in r.vec] for r in by_post.collect()}
        assert got == {key: [round(x, 9) for x in v] for key, v in want_posts.items()}, limit
        got = {r.k: [round(x, 9) for x in r.vec_sum] for r in by_period.collect()}
        assert got == {k: [round(x, 9) for x in v] for k, v in want_periods.items()}, limit
