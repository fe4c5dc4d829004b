import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.llm import mixing, packing
from tidemark.llm.tokens import Encoder, added_tokens, load_encoding

SCHEMA = "doc_id long, text string, source string, size string, row string, bucket long"
TEXTS = [None, "", "one", "two words", "a b c d e f g", "x " * 5000, "a b c d e f g", " \n ", "ö ä ü", "line\n\nline  two "]


def docs(spark, n=60):
    rows = [Row(i if i % 17 else None, TEXTS[i % len(TEXTS)], [None, "a", "b", "hot", "hot"][i % 5], "clash", "clash", 1)
            for i in range(n)]
    return spark.createDataFrame(rows + rows[:3], SCHEMA)


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = share * sum(sizes.values()), set(names)
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total >= most * sizes[s]}
        if not full:
            for s in open_:
                target[s] = left * w[s] / total
            break
        for s in full:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_targets_and_cuts(spark):
    d = docs(spark)
    rows = mixing.mix(d, bucket_rows=3).collect()
    assert len(rows) == 63
    sizes, taken = {}, {}
    for r in rows:
        s = r.row.source
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size and r.size == len((r.row.text or "").encode().split())
    for s, t in brute_targets(sizes).items():
        assert taken[s] == int(t + 1e-9)
        assert all(abs(r.target - t) < 1e-6 and r.source_size == sizes[s] for r in rows if r.row.source == s)
    again = mixing.mix(d, bucket_rows=1000, keep_row=False).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_rows_of_the_mix(spark):
    d = docs(spark)
    out = mixing.mixed_rows(d).collect()
    assert set(out[0].asDict()) == set(d.columns)
    words = sum(len(r.text.encode().split()) for r in out)
    assert words == mixing.mix(d).agg(F.sum("taken")).collect()[0][0]


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix(spark.createDataFrame([Row(1, None, None, "", "", 1)], SCHEMA)).collect()[0].taken == 0


@pytest.mark.parametrize("text", [*TEXTS, "don't they're", "tab\tx", "a\x1cb c", " lead", "trail ", "x\r\ny z", "日本 語",
                                  "é 　 z", "a\x85b \x85", "12 345,6 !!", "<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>\ny  <|endo", "𝔘 🙂 a"])
def test_ids_equal_the_tokenizer(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = t.encode(text or "", add_special_tokens=False).ids
    assert np.frombuffer(Encoder(added=added_tokens()).ids(text), "<u4").tolist() == want
    t.encode_special_tokens = True
    want = t.encode(text or "", add_special_tokens=False).ids
    assert np.frombuffer(Encoder().ids(text), "<u4").tolist() == want
    assert load_encoding().encode_ordinary(text or "") == want


@pytest.mark.parametrize("lengths", [[], [1], [2047] * 5, [1, 2, 3, 2000, 1500, 700, 9], list(range(1, 400))])
def test_assignment_fills_sequences(lengths):
    at = {}
    taken = dict.fromkeys(range(len(lengths)), 0)
    for i, start, n, s, offset in packing.assign(lengths):
        at.setdefault(s, []).append((offset, n))
        assert n > 0 and start >= 0
        taken[i] += n
    assert list(taken.values()) == lengths
    for s, pieces in at.items():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end == 2048 or end & (end - 1) == 0
    assert sorted(at) == list(range(len(at)))


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 700, 3000).tolist()
    cost = {}
    for _, _, n, s, _ in packing.assign(lengths):
        cost[s] = cost.get(s, 0) + packing.attention_cost(n)
    shuffled, at, plain = rng.permutation(lengths), 0, []
    for n in shuffled:          # the same documents cut as they come
        while n:
            if at % 2048 == 0:
                plain.append(0)
            take = min(n, 2048 - at % 2048)
            plain[-1] += packing.attention_cost(take)
            at, n = at + take, n - take
    assert np.std(list(cost.values())[:-12]) < np.std(plain[:-1])


def test_pieces_hold_every_id_once(spark):
    d = docs(spark).repartition(3)
    pieces = packing.pack(d, length=64, group_tokens=500).collect()
    encoder = Encoder(added=added_tokens())
    want = []
    for r in d.collect():
        ids = encoder.ids(r.text) + np.array([1], "<u4").tobytes()
        want.append((str(r.doc_id), len(ids) // 4))
    got = {}
    for p in pieces:
        got[str(p.doc_id), p.doc_tokens] = got.get((str(p.doc_id), p.doc_tokens), 0) + p.length
    total = {}
    for k in want:
        total[k] = total.get(k, 0) + k[1]
    assert got == total
    by_id = {r.doc_id: encoder.ids(r.text) + np.array([1], "<u4").tobytes() for r in d.collect() if r.doc_id is not None}
    for p in pieces:
        if p.doc_id is not None:
            assert p.ids_crc32 == zlib.crc32(by_id[p.doc_id][4 * p.start:4 * (p.start + p.length)])
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    end = {}
    for s, offset, n in places:
        assert offset == end.get(s, 0)
        end[s] = offset + n
    assert all(n == 64 or n & (n - 1) == 0 for n in end.values())
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
