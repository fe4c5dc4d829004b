import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, tokencounts, whitening

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
# Letters that tokenizers treat specially: spaces of several kinds, line ends, unknown letters, the space mark.
ALPHABETS = [" \n\t\r▁aeiorstnlAB01.,;(){}é中文日Ω😀\x00\xa0　\x1c\x85<s>'", "  ▁\n", "aeinrst", "a ", " \nab'stre1é."]
EDGES = [None, "", " ", "\n", " \n", "\n ", "a", "<|endoftext|> x<s></s><unk><0x41>", "x\n\n\n y  ", " " * 70, "▁x", "a b"]


def made_texts(n, longest=60, seed=1):
    rng = random.Random(seed)
    return EDGES + ["".join(rng.choice(a) for _ in range(rng.randrange(1, longest)))
                    for a in (rng.choice(ALPHABETS) for _ in range(n))]


def table(spark, texts):
    """Null and repeated ids, and columns whose names the operators use themselves."""
    rows = [Row(i if i % 19 else None, t, "clash", 7, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:5], "doc_id long, text string, block string, cell int, n_tokens string")


# --- token counts

@pytest.mark.parametrize("path", [A_PATH, B_PATH])
def test_counts_equal_the_library(spark, path):
    sf = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = made_texts(1500) + sf + ["ab" * 3000, "".join(random.Random(5).choice("aeinrst") for _ in range(9000))]
    if path == A_PATH:
        want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    else:
        want = list(map(len, sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])))
    docs = table(spark, texts)
    got = tokencounts.count_tokens(docs, path=path, limit=1000).collect()
    known = [(i if i % 19 else None, len((t or "").encode()), n, n > 1000)
             for i, (t, n) in enumerate(zip(texts, want, strict=True))]
    assert Counter(map(tuple, got)) == Counter(known + known[:5])
    assert tokencounts.count_tokens(docs.limit(0), path=path).count() == 0


def test_rounds_equal_single_merges():
    """The arrays against one merge at a time, on random tables whose ranks are not in order of composition."""
    rng = random.Random(2)
    for _ in range(150):
        n, pairs = 4, {}
        names = ["a", "b", "c", "d"]
        for r in rng.sample(range(40), 25):
            left, right = rng.randrange(n), rng.randrange(n)
            if (left, right) not in pairs:
                whole = names[left] + names[right]
                if whole not in names:
                    names.append(whole)
                    n += 1
                pairs[left, right] = (r, names.index(whole))
        # one rank for one piece, however it is split
        least = {}
        for r, m in pairs.values():
            least[m] = min(r, least.get(m, r))
        pairs = {p: (least[m], m) for p, (_, m) in pairs.items()}
        merge = tokencounts.MergeTable(pairs, n)
        seqs = [[rng.randrange(4) for _ in range(rng.randrange(1, 25))] for _ in range(8)]

        def single(s):
            s = list(s)
            while found := [(pairs[p][0], i) for i, p in enumerate(zip(s, s[1:], strict=False)) if p in pairs]:
                _, i = min(found)
                s[i:i + 2] = [pairs[s[i], s[i + 1]][1]]
            return s

        want = [single(s) for s in seqs]
        rest, sizes = tokencounts.merge_all(np.concatenate(seqs), np.array(list(map(len, seqs))), merge)
        assert [list(x) for x in np.split(rest, np.cumsum(sizes)[:-1])] == want
        assert [tokencounts.merge_long(s, merge) for s in seqs] == want


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokencounts.counter(public_tokenizers.path("word_bpe_49k.json"))


# --- alignment

def brute_alignment(texts):
    a_tok, b_tok = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a_tok.encode_special_tokens = True
    a_bytes, b_bytes = alignment.byte_tokens(A_PATH), alignment.piece_tokens(b_tok)
    rows = []
    for t in texts:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        want = (" " + t).encode() if t else b""
        x, y = [a_bytes[i] for i in a], [b_bytes[i] for i in b]
        if b"".join(x) != want or b"".join(y) != want:
            a, b, x, y = [], [], [], []
        ends_a, ends_b = np.cumsum([len(k) for k in x]).tolist(), np.cumsum([len(k) for k in y]).tolist()
        links = [(a[i], b[j]) for i, e in enumerate(ends_a) for j, f in enumerate(ends_b) if e == f]
        parts, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            i2, j2 = ends_a.index(e) + 1, ends_b.index(e) + 1
            parts.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        rows.append((len(a), len(b), len(parts), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    return rows


def test_alignment_by_brute_force(spark):
    sf = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if len(r.text) < 1500]
    texts = made_texts(250, 30, seed=3) + sf + ["the of " * 300, "the"] * 3
    docs = table(spark, texts).repartition(5)
    rows = brute_alignment(texts)
    rows += rows[:5]
    count = Counter(p for r in rows for p in r[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    want = Counter()
    for i, (n_a, n_b, n_groups, links, digest) in enumerate(rows):
        i = i if i < len(texts) else i - len(texts)
        want[(i if i % 19 else None, n_a, n_b, n_groups, len(links), sum(count[p] == best[p[1]] for p in links),
              sum(count[p] for p in links), digest)] += 1
    got = alignment.align(docs, block_docs=40)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want

    aligned, postings = alignment.index(docs, block_docs=64)
    pairs = {(r.a, r.b): (r.n_docs, r.n_links) for r in alignment.pair_counts(postings).collect()}
    docs_of = Counter(p for r in rows for p in set(r[3]))
    assert pairs == {p: (docs_of[p], n) for p, n in count.items()}
    assert aligned.count() == len(rows)
    assert alignment.align(docs.limit(0)).count() == 0
    assert alignment.align(docs.where("text is null")).select("n_links").distinct().collect() == [Row(n_links=0)]


def test_bitmaps_round_trip():
    rng = np.random.default_rng(0)
    for n_docs in (1, 9, 64, 2000):
        lists = [np.sort(rng.choice(n_docs, rng.integers(1, n_docs + 1), replace=False)) for _ in range(30)]
        starts = np.append(0, np.cumsum([len(x) for x in lists])[:-1])
        seen = {}
        for which, dense, cells in alignment.pack_cells(np.concatenate(lists), starts, n_docs):
            docs, n = alignment.unpack_cells(cells, dense)
            for i, part in zip(which, np.split(docs, np.cumsum(n)[:-1]), strict=True):
                seen[int(i)] = part.tolist()
        assert [seen[i] for i in range(30)] == [x.tolist() for x in lists]


# --- whitening

def brute_whitening(vectors):
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * np.float32(c).astype(float)) + 100000 for c in v] for v in good], object)
    n, s = len(x), x.sum(axis=0)
    y = np.array(x - s / n, float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return n, [int(((n * r - s) ** 2).sum()) for r in x], y, values[::-1], vectors[:, ::-1]


def test_whitening_by_brute_force(spark):
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 0.3).astype(np.float32).tolist()
    bad = [None, [None] + base[0][1:], [float("nan")] + base[0][1:], [float("-inf")] + base[0][1:]]
    vectors = base + bad + base[:40]
    rows = [Row(i if i != 7 else None, v, "clash", 3) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, component int").repartition(4)
    got = whitening.fit_and_whiten(df).collect()
    n, deviation, y, values, turn = brute_whitening(vectors)
    kept = [i for i in range(len(vectors)) if not 300 <= i < 304]
    assert len(got) == 8 * n == 8 * 340
    assert all(r.n == n and r.identity_error < 1e-9 for r in got) and len({r.identity_error for r in got}) == 1
    by = {(r.vec_id, r.component): r for r in got}
    sign = {}
    for k in range(8):
        assert abs(by[0, k + 1].explained / (values[k] / values.sum()) - 1) < 1e-9
        for at, i in enumerate(kept):
            r = by[i if i != 7 else None, k + 1]
            want = y[at] @ turn[:, k] / math.sqrt(values[k])
            s = sign.setdefault(k, 1 if want * r.whitened > 0 else -1)
            assert r.deviation == deviation[at] and abs(s * want - r.whitened) < 1e-7


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert whitening.fit_and_whiten(empty).count() == 0
    assert whitening.fit_and_whiten(spark.createDataFrame([Row(1, None)], schema)).count() == 0
    same = spark.createDataFrame([Row(i, [0.25, 0.5]) for i in range(5)], schema)
    assert whitening.fit_and_whiten(same).count() == 0
    flat = spark.createDataFrame([Row(i, [float(i % 2), 1.0, float(i % 2)]) for i in range(10)], schema)
    out = whitening.fit_and_whiten(flat).collect()
    assert {r.component for r in out} == {1} and all(abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12
                                                     for r in out)
    square = spark.createDataFrame([Row(0, [1.0, 0.0]), Row(1, [-1.0, 0.0]), Row(2, [0.0, 1.0]), Row(3, [0.0, -1.0])], schema)
    tied = whitening.fit_and_whiten(square).collect()
    assert len(tied) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-9 for r in tied)
    with pytest.raises(ValueError):
        whitening.fit_and_whiten(flat.union(same)).count()


def test_deviation_above_a_long():
    x = np.array([[100000, 100001], [100002, 100001]], np.int64)
    n, sums = 10**10, np.array([10**15 + 1, 10**15 + 5], object)
    assert whitening._deviation(x, n, sums) == [
        v if (v := sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True))) < 2**63 else None for r in x]


@pytest.mark.parametrize("spectrum", [
    10.0 ** -np.arange(40), np.ones(40), np.r_[np.full(7, 5.0), np.full(3, 2.0), np.full(30, 1.0)],
    1 + 1e-7 * np.arange(40), 1 + 1e-12 * np.arange(40), np.r_[np.linspace(1, 1.0001, 12), np.linspace(.1, .2, 28)],
    np.r_[np.full(2, 3.0), np.zeros(38)], np.zeros(40)])
def test_contour_integration(spectrum):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    m = q @ np.diag(spectrum) @ q.T
    m = (m + m.T) / 2
    values, vectors = whitening.largest_pairs(m, 8)
    want = np.linalg.eigvalsh(m)[::-1][:8]
    want = want[want > 1e-13 * np.trace(m)] if np.trace(m) > 0 else want[:0]
    assert len(values) == len(want)
    if len(want):
        assert np.abs(values - want).max() < 1e-14 * 40 * want[0]
        assert np.abs(m @ vectors - vectors * values).max() < 1e-13 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-13


def test_contour_integration_among_close_eigenvalues():
    # A mixture of vectors above and below an interval has a value inside it while they have not settled.
    rng = np.random.default_rng(27)
    x = np.floor(1024 * rng.standard_normal((rng.integers(500, 60_000), 128)))
    m = np.cov(x.T, bias=True)
    values, vectors = whitening.largest_pairs(m, 8)
    want = np.linalg.eigvalsh(m)[::-1][:8]
    assert np.abs(values - want).max() < 1e-12 * np.trace(m)
    assert np.abs(m @ vectors - vectors * values).max() < 1e-12 * np.trace(m)
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 10, 30):
        m = rng.normal(size=(n, n))
        m = m + m.T
        values, shifts = np.linalg.eigvalsh(m), np.linspace(-8, 8, 50)
        got = whitening.inertia(*whitening.tridiagonal(m), shifts)
        assert got.tolist() == [int((values < s).sum()) for s in shifts]


def test_queries_are_registered():
    from tidemark.llm.queries import QUERIES
    assert {"op11_tokenizer_alignment", "op12_embedding_whitening", "op13_token_counts"} <= QUERIES.keys()


def test_session_columns(spark):
    """The digest columns of the registered queries on a small table."""
    from tidemark.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    out = QUERIES["op11_tokenizer_alignment"](spark, sf).collect()
    assert len(out) == n and all(r.n_links == r.n_groups > 0 and r.count_sum >= r.n_links for r in out)
    counts = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, sf).collect()}
    assert all(counts[r.doc_id].n_tokens == r.n_b for r in out) and len(counts) == n
    assert QUERIES["op12_embedding_whitening"](spark, sf).where(F.col("identity_error") > 1e-4).count() == 0
