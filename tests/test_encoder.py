import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.operators.embedding import encode_text
from tidemark.operators.encoder import (
    Encoder,
    contextual_encoder,
    first_ids,
    parts_at_spaces,
    random_weights,
    weight_shapes,
)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def plain(w: dict, ids: list[int]) -> np.ndarray:
    """One text, one position and one head at a time."""
    heads, dim = int(w["heads"]), w["tokens"].shape[1]
    size = dim // heads

    def norm(v, scale, shift):
        m = sum(v) / dim
        s = math.sqrt(sum((a - m) ** 2 for a in v) / dim + 1e-12)
        return np.array([(a - m) / s * b + c for a, b, c in zip(v, scale, shift, strict=True)])

    x = [norm(w["tokens"][t].astype(float) + w["positions"][i], w["norm_scale"], w["norm_shift"]) for i, t in enumerate(ids)]
    for layer in range(2):
        p = lambda name, v, layer=layer: v @ w[f"{layer}.{name}"].astype(float) + w[f"{layer}.{name}_bias"]
        q, k, v = ([p(name, row) for row in x] for name in ("query", "key", "value"))
        new = []
        for i, row in enumerate(x):
            seen = []
            for h in range(heads):
                s = slice(h * size, (h + 1) * size)
                e = [math.exp(q[i][s] @ k[j][s] / math.sqrt(size)) for j in range(len(x))]
                seen.append(sum(a / sum(e) * v[j][s] for j, a in enumerate(e)))
            y = norm(row + p("out", np.concatenate(seen)), w[f"{layer}.attention_scale"], w[f"{layer}.attention_shift"])
            up = p("up", y)
            up = np.array([0.5 * a * (1 + math.tanh(math.sqrt(2 / math.pi) * (a + 0.044715 * a ** 3))) for a in up])
            new.append(norm(y + p("down", up), w[f"{layer}.output_scale"], w[f"{layer}.output_shift"]))
        x = new
    return x[0]


@pytest.fixture(scope="module")
def weights(tmp_path_factory):
    return random_weights(str(tmp_path_factory.mktemp("w") / "w.npz"), 49_408, 16)


def test_forward_pass_against_a_plain_loop(weights):
    w = dict(np.load(weights))
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 49_408, n).tolist() for n in (1, 2, 5, 17, 2, 40)]
    want = np.array([plain(w, i) for i in ids])
    for tokens in (1, 30, 100_000):          # whatever is batched together
        assert np.abs(Encoder(w).encode(ids, tokens) - want).max() < 1e-4
    assert {k: v.shape for k, v in w.items() if k != "heads"} == weight_shapes(49_408, 16, 2, 64)


def test_encoder_on_texts(spark, weights):
    texts = [None, "", "Hello world", "a " * 300, "a " * 200, "été 日本", "Hello  WORLD"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    make = contextual_encoder(spark, weights, VOCABULARY, 49_406, 49_407)
    cut, w = Tokenizer.from_file(VOCABULARY), dict(np.load(weights))
    want = [plain(w, [49_406, *cut.encode(t or "", add_special_tokens=False).ids[:126], 49_407]) for t in texts]
    for size in (1, 3, 100):
        got = {r.id: r.vec for r in encode_text(df, "text", 16, make_encoder=make, batch_size=size).collect()}
        assert all(np.abs(np.array(got[i]) - want[i]).max() < 1e-4 for i in range(len(texts)))
    assert got[0] == got[1] and np.abs(np.array(got[3]) - got[4]).max() < 1e-4      # both cut at 128 subwords
    assert encode_text(df.where(F.lit(False)), "text", 16, make_encoder=make).count() == 0


class _Counted:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0
        self.pre_tokenizer = tokenizer.pre_tokenizer

    def encode_batch(self, texts, **how):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch(texts, **how)


def test_texts_are_read_as_far_as_their_ids_reach():
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    spaced = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))    # its pieces begin with a space
    assert parts_at_spaces(words) and not parts_at_spaces(spaced)
    texts = ["", " ", "the goal " * 5000, "x" * 9000, "   \n" * 3000 + "It's Über-odd, no? " * 900, "é ö\n" * 4000,
             "日本語の文章です。" * 500, "ΣΑΣ don't <|endoftext|> 12345 " * 300, "a" * 1023 + " b c"]
    for tokenizer in (words, spaced):
        for chars in (7, 100, 1024):
            got = first_ids(tokenizer, texts, 20, chars)
            assert got == [e.ids[:20] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    counted = _Counted(words)
    first_ids(counted, ["the goal " * 5000], 126)
    assert counted.chars <= 1024
