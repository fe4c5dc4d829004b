import random

import numpy as np
import pytest
from pyspark.sql import Row

import corpus_pipeline
from tidemark.llm import langid, mixing, neardup, pii
from tidemark.llm.common import words
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, tid string, row string, id string"
WORDS = [f"w{i}" for i in range(400)]


def frame(spark, rows):
    return spark.createDataFrame([Row(i, t, "clash", "clash", "clash") for i, t in rows], SCHEMA)


def shingles(t):
    ws = words(t)
    found, seen = [], {}
    for i in range(max(1, len(ws) - 4) if ws else 0):
        s = tuple(ws[i:i + 5])
        seen[s] = seen.get(s, 0) + 1
        found.append((s, seen[s]))
    return found


def similarity(a, b):
    """Longest common subsequence of labelled shingles over all of them."""
    a, b = shingles(a), shingles(b)
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            here = best[j + 1]
            best[j + 1] = last + 1 if x == y else max(best[j + 1], best[j])
            last = here
    common = best[-1]
    return common / (len(a) + len(b) - common) if a or b else 0.0


def brute_classes(rows):
    own = list(range(len(rows)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1] or "", rows[j][1] or ""
            if a == b or similarity(a, b) >= 0.8:
                own[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    return sorted(sorted(str(rows[i][0]) for i in g) for g in groups.values())


def corpus(rng):
    rows = []
    passage = rng.choices(WORDS, k=60)
    for k in range(12):
        base = rng.choices(WORDS, k=rng.choice([6, 40, 80, 200]))
        for v in range(rng.randrange(1, 5)):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 40)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(t)))
        rows.append((len(rows), " ".join(rng.choices(WORDS, k=40) + passage)))
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "a b"), (1004, "a c"), (1005, " \n"),
             (1006, "same " * 300), (1007, "same " * 301), (None, rows[0][1])]
    half = rows[2][1].split()
    rows.append((1008, " ".join(half[len(half) // 2:] + half[:len(half) // 2])))
    return rows


def classes(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.class_id, r.class_tid), []).append(str(r.doc_id))
    return sorted(sorted(g) for g in out.values())


@pytest.mark.parametrize("seed", [0, 1])
def test_classes_by_brute_force(spark, seed):
    rows = corpus(random.Random(seed))
    assert classes(neardup.near_classes(frame(spark, rows))) == brute_classes(rows)


def test_alike_texts_around_a_template(spark):
    """Pairs that are alike but not with any leader, which holds most of their text: none is lost."""
    rng, rows = random.Random(11), []
    template = [f"t{i}" for i in range(89)]
    for k in range(100):
        shared = [f"s{k}_{i}" for i in range(4)]
        for v in range(2):
            rows.append((len(rows), " ".join(template + shared + [f"o{k}_{v}_{i}" for i in range(11)])))
    want = sorted(sorted(map(str, (i, i + 1))) for i in range(0, len(rows), 2))
    assert similarity(rows[0][1], rows[1][1]) >= 0.8 > similarity(rows[0][1], rows[2][1])
    rng.shuffle(rows)
    assert classes(neardup.near_classes(frame(spark, rows))) == want


def test_prefixes_of_alike_texts_meet():
    rng = np.random.default_rng(4)
    classes_ = rng.integers(0, 9, neardup.BUCKETS).astype(np.uint8)
    for _ in range(300):
        a = np.unique(rng.integers(1, 1 << 63, rng.integers(1, 60), dtype=np.uint64))
        kept = a[rng.random(len(a)) < 0.9]
        b = np.unique(np.append(kept, rng.integers(1, 1 << 63, rng.integers(0, 6), dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if both / (len(a) + len(b) - both) >= 0.8:
            x, y = sorted((a, b), key=len)
            first, n = neardup.prefix(x, classes_, 0.8)
            assert np.isin(first[:n], neardup.prefix(y, classes_, 0.8)[0]).any()


def test_alignment_by_brute_force():
    rng = random.Random(3)
    seen = neardup._Hashes()
    for _ in range(200):
        a = rng.choices(WORDS[:rng.choice([3, 30, 400])], k=rng.randrange(1, 60))
        b = list(a)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.randrange(2)] = rng.choices(WORDS, k=rng.randrange(2))
        a, b = " ".join(a), " ".join(b)
        want = similarity(a, b)
        got = neardup.alignment(*(neardup.labelled(neardup.word_hashes(t, seen)) for t in (a, b)))
        assert got == pytest.approx(want) if want >= 0.8 else got == 0.0


def test_sketches_keep_order():
    seen = neardup._Hashes()
    ws = random.Random(4).sample(WORDS, 100)
    one, two = (neardup.sketch(neardup.labelled(neardup.word_hashes(" ".join(t), seen))) for t in
                (ws, ws[50:] + ws[:50]))
    same = sum(a == b for a, b in zip(one, two, strict=True))
    assert same < neardup.SKETCHES * 0.6       # the same words, but in another order
    assert neardup.sketch(np.zeros(0, np.uint64)) == []


def test_crowds_lose_no_link(spark):
    # Under every key more texts than give all their pairs: a chain of near copies, and a shared passage.
    rng = random.Random(5)
    base = rng.choices(WORDS, k=150)
    rows = []
    for i in range(30):
        t = list(base)
        t[(i * 5) % 150] = f"x{i}"
        rows.append((i, " ".join(t)))
    far = list(base)
    for i in range(0, 12):
        far[i * 10] = f"y{i}"
        rows.append((100 + i, " ".join(far)))
    rows += [(200 + i, " ".join(base[:75] + rng.choices(WORDS, k=60))) for i in range(10)]
    d = frame(spark, rows)
    roots = components(neardup.near_links(d, pairs_up_to=3).select("a", "b"))
    groups = {}
    for r in (d.select("doc_id", neardup.text_key(d["text"]).alias("node")).join(roots, "node", "left").collect()):
        groups.setdefault(bytes(r.root or r.node), []).append(str(r.doc_id))
    assert sorted(sorted(g) for g in groups.values()) == brute_classes(rows)


def test_one_of_each_class_stays(spark):
    rows = corpus(random.Random(6))
    rows += rows[:3]
    d = frame(spark, rows)
    kept = neardup.keep_one(d)
    assert kept.columns == d.columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    lowest = lambda g: min(g, key=lambda x: (x == "None", int(x) if x != "None" else 0))
    assert got == sorted(lowest(g) for g in brute_classes(rows))
    assert neardup.keep_one(frame(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(70)]
    edges += [(600, 600 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    own = {n: n for e in edges for n in e}
    for _ in range(400):
        for a, b in edges:
            own[a] = own[b] = min(own[a], own[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: own[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 700").orderBy("doc_id").limit(40)
    extra = spark.createDataFrame([Row(9001, None, None, "src1", 0), Row(9002, "12 34 !!", "en", None, 8)], docs.schema)
    sf = str(tmp_path)
    docs.unionByName(extra).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    one = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    model = langid.fit(langid.training_rows(docs))
    good = {r.doc_id for r in langid.identify(docs, model).collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == good
    verdict = {r.doc_id: r.lang_pred != "und" and r.score >= 0.5 for r in langid.identify(docs, model).collect()}
    assert not good & {9001, 9002} and len(good) == sum(verdict.values()) >= 30

    two = corpus_pipeline.STAGES[1][1](spark, one, sf)
    groups = brute_classes([(i, rows[i].text) for i in sorted(good)])
    assert two.columns == docs.columns
    assert sorted(r.doc_id for r in two.collect()) == sorted(min(map(int, g)) for g in groups)

    three = corpus_pipeline.STAGES[2][1](spark, two, sf)
    changed = {r.doc_id: r for r in three.collect()}
    assert three.columns == docs.columns and set(changed) == {r.doc_id for r in two.collect()}
    for i, r in changed.items():
        found = [v for _, _, _, v in pii.detect(rows[i].text)]
        assert (r.text == rows[i].text) == (not found) and not any(v in r.text for v in found)
        assert r.n_chars == len(r.text)

    four = corpus_pipeline.STAGES[3][1](spark, three, sf)
    mixed = four.collect()
    taken = {r.doc_id: r.taken for r in mixing.mix(three, keep_row=False).collect()}
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert changed[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text)
    assert four.columns == docs.columns and got == {i: n for i, n in taken.items() if n}

    pieces = corpus_pipeline.run(spark, sf).collect()
    per_copy = sorted((r.doc_id, len(words(r.text))) for r in mixed)
    assert len({p.doc_id for p in pieces}) == len(got)
    assert sum(p.start == 0 for p in pieces) == len(per_copy)
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_an_empty_table_and_extra_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tid string, row string, made string, " \
             "key string, class_id string, bucket int, size string, hash string, root string"
    rows = [(i if i else None, t, "en", s, 0, *"abcde", 7, *"fgh") for i, (t, s) in enumerate(
        [("Write to anna.smith@example.com about the plan of the week " * 3, "x"), (None, "x"), ("", None),
         ("The cat and the dog sat on the mat in the house of the man", None)] * 2)]
    for name, data in (("empty", []), ("clash", rows)):
        sf = str(tmp_path / name)
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/documents.parquet")
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            if data and stage is corpus_pipeline.STAGES[2][1]:
                kept = {r.doc_id: r for r in docs.collect()}
                for r in out.collect():
                    assert "anna.smith" not in r.text and r[5:] == kept[r.doc_id][5:] and r.made == "c"
            docs = corpus_pipeline.written(out, "test-stage")
        pieces = corpus_pipeline.run(spark, sf).collect()
        assert (len(pieces) == 0) == (not data)
