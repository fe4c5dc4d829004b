import math
import random
import zlib

import numpy as np
from pyspark.sql import Row

from tidemark.llm import langid, lm, quality, toxicity
from tidemark.llm.common import fold, fold_col, words

SCHEMA = "doc_id long, text string, lang string, score double, words string, uid long"
EDGE = [None, "", "  \n ", "42 !!", "a", "x" * 5000, "same same same " * 200]


def edge_rows(spark, langs=("en", None)):
    rows = [Row(i, t, langs[i % len(langs)], 1.0, "clash", 3) for i, t in enumerate(EDGE)]
    return spark.createDataFrame([*rows, rows[4], Row(None, "hello there", "en", 1.0, "clash", 3)], SCHEMA)


def test_fold_matches_crc32(spark):
    ids = [0, 1, 17, 123456789, None]
    got = spark.createDataFrame([Row(i) for i in ids], "doc_id long").select(fold_col("doc_id", 10)).collect()
    assert [g[0] for g in got] == [fold(i, 10) for i in ids]
    assert fold(17, 10) == zlib.crc32(b"17") % 10


# Language ID ---------------------------------------------------------------

def all_segmentations(word, p, index):
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in index:
            total += p[index[word[:k]]] * all_segmentations(word[k:], p, index)
        elif k == 1:
            total += langid.UNKNOWN * all_segmentations(word[1:], p, index)
    return total


def test_forward_sums_all_segmentations():
    pieces = sorted(["a", "b", "ab", "ba", "aba", langid._START, langid._START + "a", "é"])
    lattice = langid.Lattice(pieces)
    p = np.append(np.random.default_rng(0).dirichlet(np.ones(len(pieces))), 0.0)
    index = {x: i for i, x in enumerate(pieces)}
    for word in (langid._START + "ababa", langid._START + "zé", "aaab", langid._START + "b"):
        got = langid.forward(lattice.of([word]), p[:, None])[-1, 0, 0]
        assert math.isclose(got, all_segmentations(word, p, index), rel_tol=1e-9)


def test_fitting_raises_the_likelihood():
    pieces = langid.vocabulary()[:4000] + [c for c in "abcdefghijklmnopqrstuvwxyz"]
    lattice = langid.Lattice(sorted(set(pieces)))
    found = langid.split_words("the thing that the others think of the mother and father") * 3
    counts = np.ones(len(found))

    def likelihood(rounds):
        p = langid.fit_language(found, counts, lattice, rounds)
        return sum(math.log(langid.forward(lattice.of([w]), p[:, None])[-1, 0, 0]) for w in found)
    assert likelihood(1) < likelihood(2) < likelihood(4)


def test_languages_on_edges(spark):
    rng = random.Random(1)
    vocab = {"en": "the of and to in that with".split(), "de": "der und die das nicht ist ein".split()}
    train = spark.createDataFrame([Row(i, " ".join(rng.choices(vocab[lang], k=30)), lang, 0.0, "", 1) for i, lang in
                                   enumerate(["en", "de"] * 20)], SCHEMA)
    model = langid.fit(train)
    out = {r.doc_id: r for r in langid.identify(train, model).collect()}
    assert all(out[r.doc_id].lang_pred == r.lang for r in train.collect())
    edge = langid.identify(edge_rows(spark), model).collect()
    assert len(edge) == len(EDGE) + 2
    assert [r.lang_pred for r in edge[:4]] == ["und"] * 4 and [r.score for r in edge[:4]] == [0.0] * 4
    assert all(0 <= r.score <= 1 for r in edge)
    assert langid.identify(spark.createDataFrame([], SCHEMA), model).count() == 0
    none = langid.fit(spark.createDataFrame([], SCHEMA))
    assert {r.lang_pred for r in langid.identify(edge_rows(spark), none).collect()} == {"und"}
    kept = langid.keep_identified(edge_rows(spark), model)
    assert kept.columns == edge_rows(spark).columns
    assert kept.count() == sum(r.score >= 0.5 for r in edge)


# Quality -------------------------------------------------------------------

def brute_repeat(ws, n=8):
    seen, hit = {}, set()
    for i in range(len(ws) - n + 1):
        seen.setdefault(tuple(ws[i:i + n]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(j for i in at for j in range(i, i + n))
    return len(hit)


def test_repeated_words_by_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        ws = [bytes([97 + rng.randrange(2)]) for _ in range(rng.randrange(60))]
        assert quality.repeated_words(ws) == brute_repeat(ws)
        assert quality.repeated_words(ws, 3) == brute_repeat(ws, 3)


def test_cascade_equals_all_rules_in_any_order(spark):
    texts = [*EDGE, "word " * 30, "a normal sentence with several words that says something of use to whoever reads it "
             "today and then some more", "SHOUT! " * 40, "# $ % & " * 20, "l\n" * 50]
    d = spark.createDataFrame([Row(i, t, None, 0.0, "", 1) for i, t in enumerate(texts)], SCHEMA)
    got = quality.cascade(d, report=("n_words", "n_dup_lines")).collect()
    for r, t in zip(sorted(got, key=lambda r: r.doc_id), texts, strict=True):
        item = quality.Text(t)
        assert r.kept == (not any(x.rejects(item) for x in quality.RULES))
        assert r.n_words == len((t or "").encode().split())
    assert quality.cascade(spark.createDataFrame([], SCHEMA)).count() == 0
    # cheap rules that reject much come first
    order = quality.plan({r.name: (0.5 if r.name == "symbols" else 0.1, 1.0) for r in quality.RULES})
    assert order[0].name == "symbols"


# Toxicity ------------------------------------------------------------------

def clause(symbols):
    nxt, gain = toxicity.table(toxicity.grammar())
    state = total = 0
    for s in symbols:
        total += gain[state][s]
        state = nxt[state][s]
    return total


def test_grammar_weighs_clauses():
    t = toxicity
    plain = clause([t.OTHER, t.INSULT])
    assert plain == 1.0
    assert clause([t.TARGET, t.INSULT]) > plain
    assert clause([t.NEG, t.OTHER, t.INSULT]) < plain
    assert clause([t.NEG, t.OTHER, t.OTHER, t.OTHER, t.OTHER, t.INSULT]) == plain
    assert clause([t.REPORT, t.OTHER, t.INSULT]) < plain
    assert clause([t.THREAT]) == 0 and clause([t.THREAT, t.OTHER, t.TARGET]) == 1.0
    assert clause([t.OTHER, t.TARGET]) == 0


def test_composition_adds_weights_and_feeds_outputs():
    a = toxicity.Transducer({(0, 1): (1, 2, 0.5), (1, 1): (0, 1, 0.25)}, {1: 1.0})
    b = toxicity.Transducer({(0, 2): (1, 3, 2.0)})
    c = toxicity.compose(a, b)
    state, out, w = c.step(0, 1)
    assert (out, w) == (3, 2.5)
    assert c.final[state] == 1.0
    assert c.step(state, 1)[1:] == (1, 0.25)


def test_toxicity_learns_stems_and_scores_edges(spark):
    rng = random.Random(2)
    neutral = [f"w{chr(97 + i)}{chr(97 + j)}z" for i in range(26) for j in range(10)]
    rows, labels = [], []
    for i in range(200):
        toxic = i % 4 == 0
        ws = rng.choices(neutral, k=60)
        if toxic:
            ws[10] = "grobix" + rng.choice(neutral)
            ws[30] = "plonk"
        rows.append(Row(i, " ".join(ws) + ".", None, 0.0, "", 1))
        labels.append(Row(i, int(toxic)))
    d = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([*labels, Row(None, 1), Row(5, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels)
    assert any("grob".startswith(s[:4]) for s in model.stems) and any(s.startswith("plonk"[:4]) for s in model.stems)
    out = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
    held = [i for i in range(200) if fold(i, 4) == 2]
    assert all((out[i] >= 0.3) == (i % 4 == 0) for i in held)
    edge = toxicity.score(edge_rows(spark), model).collect()
    assert len(edge) == len(EDGE) + 2 and all(0 <= r.score < 0.3 and r.n_clauses == 0 for r in edge)
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0


# Language model -------------------------------------------------------------

def test_windows_score_every_place_once():
    for lengths in ([], [1], [16], [17], [28], [29], [5, 0, 100, 1]):
        read, places, exists = lm.windows(np.array(lengths, int))
        assert sorted(places[exists].tolist()) == list(range(sum(lengths)))
        assert read.shape[1] == lm.WINDOW and (places[~exists] == -1).all()


def test_probabilities_sum_to_one_and_are_causal():
    rng = np.random.default_rng(0)
    net = lm.Network.new(rng.integers(1, 50, 300), rng)
    x = rng.integers(0, 300, (2, lm.WINDOW)).astype(np.uint16)
    h, a = net.attend(x)
    assert np.allclose(np.triu(a[0], 1), 0)
    every = np.arange(lm.CLASSES * lm.MEMBERS)
    p = np.exp(net.logp(np.repeat(h[0, 3:4], len(every), 0), every))
    assert abs(p.sum() - 1) < 1e-4
    y = x.copy()
    y[:, 9] = 7                                   # a later id does not change earlier states
    assert np.allclose(net.attend(y)[0][:, :9], h[:, :9])


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = lm.Network.new(rng.integers(1, 50, 100), rng)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    net = lm.Network(net.p)
    net.bias = net.bias.astype(np.float64)
    x, y = rng.integers(0, 100, (3, lm.WINDOW)), rng.integers(0, 100, (3, lm.WINDOW))
    used = rng.random((3, lm.WINDOW)) < 0.7
    _, g = net.gradients(x, y, used)
    for k in ("E", "Wq", "Wk", "Wv", "Wr", "Uc", "Um", "bc", "bm"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        eps = 1e-5
        old = net.p[k][at]
        net.p[k][at] = old + eps
        up = net.gradients(x, y, used)[0]
        net.p[k][at] = old - eps
        down = net.gradients(x, y, used)[0]
        net.p[k][at] = old
        assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-3 * max(1, abs(g[k][at])), k


def test_parameters_are_stepped_as_one_array():
    rng = np.random.default_rng(5)
    net = lm.Network.new(rng.integers(1, 50, 200), rng)
    old = {k: v.copy() for k, v in net.p.items()}
    adam = lm.Adam(net)
    x, y = rng.integers(0, 200, (2, 6, lm.WINDOW)).astype(np.uint16)
    used = np.zeros(x.shape, bool)
    used[:, lm.WINDOW - lm.STRIDE:] = True
    _, g = net.gradients(x, y, used)
    adam.step(x, y, used, 0.05)
    assert adam.all.size == sum(v.size for v in old.values())
    for k, v in net.p.items():                   # Adam's first step: the rate (0.05 / 50) times the gradient's sign
        assert np.shares_memory(v, adam.all) and v.dtype == np.float32
        assert np.allclose(v, old[k] - 1e-3 * g[k] / (np.abs(g[k]) + 1e-8), atol=2e-6), k


def test_gradients_by_number_equal_those_by_place():
    rng = np.random.default_rng(6)
    x, d = rng.integers(0, 9, 50), rng.standard_normal((50, 3))
    assert np.allclose(lm.sums_by(x, d, 12), [d[x == i].sum(0) for i in range(12)])
    net = lm.Network.new(rng.integers(1, 50, 200), rng)
    net.p["bc"][3] = 300                         # logits far beyond what exp can take
    _, g = net.gradients(*rng.integers(0, 200, (2, 4, lm.WINDOW)), rng.random((4, lm.WINDOW)) < 0.5)
    assert all(np.isfinite(v).all() for v in g.values())


def test_a_worker_keeps_the_numbers_of_words():
    ids = tuple(range(300, 900))
    size = lm.load_encoding(None).n_vocab
    kept = lm.known_numbers(ids, size, None)
    assert kept[b"the"] == lm.Vocabulary(list(ids), size).numbers(b"the")
    assert lm.known_numbers(ids, size, None) is kept and b"the" in kept
    assert lm.known_numbers(ids[1:], size, None) is not kept


def test_training_learns_a_repeated_pattern():
    texts = [np.array([2, 3, 4, 5] * 30, np.uint16) for _ in range(4)]
    flat, lengths = np.concatenate([np.append(t, 0) for t in texts]).astype(np.uint16), np.full(4, 121)
    before = lm.train(texts, steps=1, batch=8).score(flat, lengths, 0.0).mean()
    after = lm.train(texts, steps=120, batch=8).score(flat, lengths, 0.0).mean()
    assert after > -0.5 > before


def test_scores_by_brute_force(spark):
    rng = random.Random(3)
    vocab = ["alpha", "beta", "Gamma", "the", "of", "straße", "x1"]
    texts = {i: " ".join(rng.choices(vocab, k=40)) for i in range(60)}
    texts |= {60: None, 61: "", 62: " \n ", 63: "unseen zzz qqq", 64: texts[3]}
    rows = [Row(i, t, None, 1.0, "clash", 7) for i, t in texts.items()] + [Row(None, "the of", None, 1.0, "", 7)]
    d = spark.createDataFrame(rows, SCHEMA)
    # with three words sent to all tasks the others meet their counts in the join
    out = lm.fit_and_score(d, top_words=3, steps=5).collect()
    assert len(out) == len(rows)
    train = [(r[0], r[1]) for r in rows if fold(r[0], 10)]
    counts = {}
    for _, t in train:
        for w in words(t):
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    got = {r.doc_id: r for r in out}
    for doc, text, *_ in rows:
        ws = words(text)
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        base += math.log10((len(train) + 0.1) / (n + 0.1 * (v + 1)))
        o = got[doc]
        assert o.train_tokens == n and o.n_tokens == len(ws) + 1 and o.held_out == (fold(doc, 10) == 0)
        assert o.n_known == sum(w in counts for w in ws) + 1
        assert math.isclose(o.base_score, base, rel_tol=1e-9)
        assert o.score < 0
    many = {r.doc_id: r.score for r in lm.fit_and_score(d, top_words=1000, steps=5).collect()}
    assert all(math.isclose(many[k], got[k].score, rel_tol=1e-3) for k in got)
    assert lm.fit_and_score(spark.createDataFrame([], SCHEMA), steps=2).count() == 0


def test_held_out_text_is_likelier_than_by_the_base(spark):
    out = lm.fit_and_score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = [r for r in out.collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_long_words_are_scored_whole():
    """Scaled values over any length equal the sum over all segmentations; pieces of all lengths are used."""
    pieces = langid.vocabulary()
    assert max(map(len, pieces)) >= 12 and len(pieces) > 20_000
    lattice = langid.Lattice(pieces)
    rng = random.Random(3)
    p = np.append(rng_p := np.random.default_rng(1).dirichlet(np.ones(len(pieces))), 0.0)[:, None]
    assert abs(rng_p.sum() - 1) < 1e-9
    for n in (1, 5, 23, 24, 25, 60, 130):
        word = langid._START + "".join(rng.choice("aeinrstlmo") for _ in range(n))
        lat = lattice.of([word])
        want = math.log(langid.forward(lat, p)[-1, 0, 0])
        assert abs(langid.log_total(lat, p)[0, 0] - want) < 1e-9 * abs(want)
    assert np.isfinite(langid.log_total(lattice.of([langid._START + "q" * 3000]), p)).all()


def test_fit_in_tasks_equals_one_place(spark):
    """The distributed rounds give the probabilities of the plain ones, and a rare language is learned."""
    rows = [Row(i if i % 5 else None, t, "en") for i, t in enumerate(["the cat sat on the mat", "a cat and the hat " * 3] * 20)]
    rows += [Row(900, "katten satt på mattan", "sv"), Row(901, None, "sv"), Row(902, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(df)
    assert model.languages == ["en", "sv"]
    lattice = langid.Lattice(model.pieces)
    for lang in model.languages:
        words = [w for r in rows if r[2] == lang for w in langid.split_words(r[1])]
        p = langid.fit_language(sorted(set(words)), np.array([words.count(w) for w in sorted(set(words))], float), lattice)
        assert np.abs(p - model.p[:, model.languages.index(lang)]).max() < 1e-9
    few = langid.fit(df, max_docs=3)
    assert few.languages == ["en", "sv"]


def test_network_scores_against_a_plain_loop():
    """One target at a time: its window, its attention position by position, its class and member."""
    rng = np.random.default_rng(4)
    net = lm.Network.new(np.ones(50), rng)
    net.p["b"] = rng.standard_normal(lm.WINDOW).astype(np.float32)
    net = lm.Network(net.p)
    p = {k: v.astype(float) for k, v in net.p.items()}
    texts = [rng.integers(0, lm.CLASSES * lm.MEMBERS, n) for n in (1, 2, 12, 13, 16, 31, 60)]

    def plain(t, j):
        before = [lm.END, *t[:-1].tolist()]
        start = j // lm.STRIDE * lm.STRIDE - (lm.WINDOW - lm.STRIDE)
        seen = [before[i] if i >= 0 else lm.END for i in range(start, j + 1)]
        q = p["E"][seen[-1]] @ p["Wq"] / math.sqrt(lm.KEY_WIDTH)
        e = [math.exp(min(60, q @ (p["E"][x] @ p["Wk"]) + p["b"][len(seen) - 1 - i])) for i, x in enumerate(seen)]
        h = p["E"][seen[-1]] @ p["Wr"] + sum(a / sum(e) * (p["E"][x] @ p["Wv"]) for a, x in zip(e, seen, strict=True))
        c, m = divmod(int(t[j]), lm.MEMBERS)
        z, zm = h @ p["Uc"] + p["bc"], h @ p["Um"][c] + p["bm"][c]
        return z[c] - math.log(np.exp(z).sum()) + zm[m] - math.log(np.exp(zm).sum()) + (-3.0 if t[j] == lm.RARE else 0)

    got = net.score(np.concatenate(texts).astype(np.uint16), np.array(list(map(len, texts))), -3.0)
    want = [plain(t, j) for t in texts for j in range(len(t))]
    assert np.abs(got - want).max() < 1e-3


def test_network_learns_from_every_document(spark):
    """A round's network is the mean of the tasks' networks, by windows; every document outside the start's sample
    comes in one round, and the ids of the whole corpus are counted."""
    rng = random.Random(5)
    rows = [Row(doc_id=i, text=" ".join(rng.choice("red green blue one two".split()) for _ in range(rng.randint(0, 60))))
            for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id").cache()
    counts = lm.word_counts(docs)
    ids = {r.id: r.n for r in lm.id_counts(counts, None).collect()}
    encode = lm.load_encoding(None).encode_ordinary
    assert ids == {i: sum(encode(" " + w.decode()).count(i) for r in rows for w in words(r.text)) for i in ids}
    vocabulary = lm.Vocabulary(sorted(ids), lm.load_encoding(None).n_vocab)
    start = lm.Network.new(np.ones(10), np.random.default_rng(3))
    got = lm.train_round(docs, start, vocabulary, 1e-3)
    mean, total = {k: 0.0 for k in start.p}, 0
    for part in docs.select("text").rdd.glom().collect():
        if part:
            net = lm.Network({k: v.copy() for k, v in start.p.items()})
            texts = [np.frombuffer(b"".join(map(vocabulary.numbers, words(r.text))), np.uint16) for r in part]
            n = lm.train_on(net, texts, lm.Adam(net), np.random.default_rng(1), 1e-3)
            assert n == sum(-(-(len(t) + 1) // lm.STRIDE) for t in texts)
            mean, total = {k: mean[k] + n * (net.p[k] - start.p[k]) for k in mean}, total + n
    for k, v in mean.items():
        assert np.abs(got.p[k] - start.p[k] - v / total).max() < 2e-6, k
        assert k == "b" or np.abs(v).max() > 0, k

    used = []
    plain, lm.train_round = lm.train_round, lambda d, net, *_: used.extend(r.doc_id for r in d.collect()) or net
    try:
        lm.fit(docs, counts, max_docs=8, steps=2)
    finally:
        lm.train_round = plain
    assert len(used) == len(set(used)) and 20 <= len(used) < 40
