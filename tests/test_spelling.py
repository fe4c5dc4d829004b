import itertools
import subprocess
import sys
import os

from tidemark.operators.lemma import lemmatize_tokens
from tidemark.operators.spelling import candidate_pairs, correct_tokens, delete_keys, osa, with_delete_hashes

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_osa_values():
    assert osa("goal", "gaol") == 1
    assert osa("ca", "abc") == 3        # restricted: no edit inside a transposed pair
    assert osa("tech", "the") == 3
    assert osa("", "ab") == 2 and osa("abc", "abc") == 0
    assert osa("abcd", "badc") == 2     # two transpositions


def _brute(tokens, dictionary):
    out = {}
    for t in tokens:
        if t in dictionary:
            out[t] = (t, 0)
            continue
        best = min(((osa(t, w), -c, w) for w, c in dictionary.items()), default=None)
        out[t] = (best[2], best[0]) if best and best[0] <= 2 else (t, None)
    return out


def test_blocked_join_equals_brute_force(spark):
    words = ["goal", "match", "penalty", "card", "yellow", "kick", "referee", "keeper",
             "striker", "offside", "corner", "header", "abcdefghij", "ab"]
    dictionary = {w: 100 - i for i, w in enumerate(words)}
    tokens = set(words)
    for w in words:   # every single edit of each word, and some double edits
        for i in range(len(w)):
            tokens.add(w[:i] + w[i + 1:])
            tokens.add(w[:i] + "x" + w[i + 1:])
            if i + 1 < len(w):
                tokens.add(w[:i] + w[i + 1] + w[i] + w[i + 2:])
        tokens.add("zz" + w)
        tokens.add(w[::-1])
    tokens.discard("")
    tdf = spark.createDataFrame([(t,) for t in sorted(tokens)], "token string")
    ddf = spark.createDataFrame(list(dictionary.items()), "term string, cnt long")
    got = {r.token: (r.corrected, r.distance) for r in correct_tokens(tdf, ddf).collect()}
    assert got == _brute(tokens, dictionary)


def test_delete_keys_count(spark):
    df = spark.createDataFrame([("abcdefghij",), ("ab",)], "w string")
    keys = [set(r[0]) for r in df.select(delete_keys("w", prefix_length=7)).collect()]
    assert len(keys[0]) == 1 + 7 + 21           # prefix of 7, distinct letters
    assert keys[1] == {"ab", "a", "b", ""}


def test_delete_hashes_are_shared_as_the_keys_are(spark):
    words = ["", "a", "b", "ab", "ba", "aab", "aaaa", "abcdefghij", "abcdefgihj", "été", "ete", "наука", "😀ab", "ab😀",
             "x" * 20 + "yz", "x" * 20, "abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)] + [(None, -1)], "w string, i int")
    for k, prefix in itertools.product((1, 2), (7, 20)):
        keys = {r.i: set(r.k) for r in df.where("w is not null").select(
            "i", delete_keys("w", k, prefix).alias("k")).collect()}
        hashes = {}
        for r in with_delete_hashes(df, k, prefix).collect():
            assert r.w == words[r.i] and r.key not in hashes.setdefault(r.i, set())
            hashes[r.i].add(r.key)
        assert {i: len(h) for i, h in hashes.items()} == {i: len(x) for i, x in keys.items()}
        for i, j in itertools.combinations(keys, 2):
            assert len(keys[i] & keys[j]) == len(hashes[i] & hashes[j])


def test_candidates_are_looked_for_without_strings_of_keys(spark):
    toks = spark.createDataFrame([("gaol",), ("kikc",), (None,)], "token string")
    terms = spark.createDataFrame([("goal", 3), ("kick", 2), (None, 1)], "term string, cnt long")
    pairs = candidate_pairs(toks, terms)
    assert {(r.token, r.term, r.dist) for r in pairs.collect()} == {("gaol", "goal", 1), ("kikc", "kick", 1)}
    assert "transform(" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_lemma_rules(spark):
    vocab = spark.createDataFrame([(w,) for w in ["box", "glass", "city", "man", "wolf", "dish"]],
                                  "term string")
    toks = spark.createDataFrame([(w,) for w in ["boxes", "glasses", "cities", "men", "wolves",
                                                 "dishes", "glass", "unknowns", "children"]],
                                 "token string")
    exc = spark.createDataFrame([("children", "child")], "token string, lemma string")
    got = dict(lemmatize_tokens(toks, vocab, exc).collect())
    assert got == {"boxes": "box", "glasses": "glass", "cities": "city", "men": "man",
                   "wolves": "wolf", "dishes": "dish", "glass": "glass", "unknowns": "unknowns",
                   "children": "children"}


def test_spelling_bruteforce_script_sf0001():
    r = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "spelling_bruteforce.py"),
                        "/root/testdata/sf0.001"], capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stdout[-2000:] + r.stderr[-2000:]
    assert "mismatches=0" in r.stdout
