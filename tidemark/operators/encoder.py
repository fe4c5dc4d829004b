"""A contextual text encoder for ``encode_text``: self-attention over subword ids, first position as vector.

The original encodes posts with a pretrained bidirectional transformer, cut at 128
subwords, and takes the first position of the last layer. Weights and vocabulary
are inputs here: an ``.npz`` file in the layout of :func:`weight_shapes` (the usual
post-norm encoder) and a ``tokenizers`` file. Both are handed to Spark's file
distribution once (``addFile``: each node fetches a file once) and opened once a
Python worker.

Texts of a batch are put in order of length and run together up to ``TOKENS``
positions, so that little is padded. Padding is masked out of the attention, so a
text's vector does not depend on what it is batched with.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

MAX_SUBWORDS = 128
CHARS = 1024             # of a text that are cut into subwords first
TOKENS = 8192            # positions of one forward pass: bounds the memory of activations


def weight_shapes(vocabulary: int, dim: int, layers: int, hidden: int, positions: int = MAX_SUBWORDS) -> dict[str, tuple]:
    """Names and shapes of an encoder's arrays; ``heads`` is a scalar beside them."""
    out: dict[str, tuple] = {"tokens": (vocabulary, dim), "positions": (positions, dim), "norm_scale": (dim,),
                             "norm_shift": (dim,)}
    for i in range(layers):
        for name in ("query", "key", "value", "out"):
            out |= {f"{i}.{name}": (dim, dim), f"{i}.{name}_bias": (dim,)}
        out |= {f"{i}.up": (dim, hidden), f"{i}.up_bias": (hidden,), f"{i}.down": (hidden, dim), f"{i}.down_bias": (dim,)}
        for name in ("attention", "output"):
            out |= {f"{i}.{name}_scale": (dim,), f"{i}.{name}_shift": (dim,)}
    return out


def random_weights(path: str, vocabulary: int, dim: int = 32, layers: int = 2, heads: int = 4, seed: int = 42) -> str:
    """An ``.npz`` file of seeded random weights (trained ones are an input); returns its path."""
    rng = np.random.default_rng(seed)
    arrays = {}
    for name, shape in weight_shapes(vocabulary, dim, layers, 4 * dim).items():
        kind = name.rsplit("_", 1)[-1]
        arrays[name] = (np.ones(shape) if kind == "scale" else np.zeros(shape) if kind == "shift"
                        else rng.normal(0, 0.02 if len(shape) == 1 else shape[-1] ** -0.5, shape)).astype(np.float32)
    np.savez(path, heads=np.array(heads), **arrays)
    return path


def normed(x: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    x = x - x.mean(axis=-1, keepdims=True)
    return x / np.sqrt((x * x).mean(axis=-1, keepdims=True) + 1e-12) * scale + shift


def gelu(x: np.ndarray) -> np.ndarray:
    return 0.5 * x * (1 + np.tanh(np.sqrt(2 / np.pi).astype(x.dtype) * (x + 0.044715 * x ** 3)))


class Encoder:
    """The forward pass over ids that are padded to one length."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: v for k, v in weights.items() if k != "heads"}
        self.heads = int(weights["heads"])
        self.layers = 1 + max((int(k.split(".")[0]) for k in self.w if "." in k), default=-1)

    def first_position(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        w, (n, length) = self.w, ids.shape
        x = normed(w["tokens"][ids] + w["positions"][:length], w["norm_scale"], w["norm_shift"])
        hidden = np.where(np.arange(length)[None, :] < lengths[:, None], 0.0, -np.inf).astype(x.dtype)[:, None, None, :]
        dim = x.shape[-1]
        for i in range(self.layers):
            # Only the first position is asked for, so the last layer asks for it alone.
            asks = x[:, :1] if i == self.layers - 1 else x

            def part(name: str, rows: np.ndarray, i: int = i) -> np.ndarray:
                y = rows @ w[f"{i}.{name}"] + w[f"{i}.{name}_bias"]
                return y.reshape(n, rows.shape[1], self.heads, dim // self.heads).transpose(0, 2, 1, 3)

            score = part("query", asks) @ part("key", x).transpose(0, 1, 3, 2)
            score = score / np.sqrt(dim // self.heads).astype(x.dtype) + hidden
            score = np.exp(score - score.max(axis=-1, keepdims=True))
            seen = (score / score.sum(axis=-1, keepdims=True)) @ part("value", x)
            seen = seen.transpose(0, 2, 1, 3).reshape(n, asks.shape[1], dim)
            y = normed(asks + seen @ w[f"{i}.out"] + w[f"{i}.out_bias"], w[f"{i}.attention_scale"], w[f"{i}.attention_shift"])
            up = gelu(y @ w[f"{i}.up"] + w[f"{i}.up_bias"])
            x = normed(y + up @ w[f"{i}.down"] + w[f"{i}.down_bias"], w[f"{i}.output_scale"], w[f"{i}.output_shift"])
        return x[:, 0]

    def encode(self, ids: list[list[int]], tokens: int = TOKENS) -> np.ndarray:
        """One vector a list of ids (each of one id at least), in batches of like length."""
        order = sorted(range(len(ids)), key=lambda i: len(ids[i]))
        out = np.zeros((len(ids), self.w["tokens"].shape[1]), np.float32)
        start = 0
        while start < len(order):
            end = start + 1
            while end < len(order) and (end + 1 - start) * len(ids[order[end]]) <= tokens:
                end += 1
            part = order[start:end]
            lengths = np.array([len(ids[i]) for i in part])
            padded = np.zeros((len(part), lengths.max()), np.int64)
            for row, i in enumerate(part):
                padded[row, :len(ids[i])] = ids[i]
            out[part] = self.first_position(padded, lengths)
            start = end
        return out


def parts_at_spaces(tokenizer) -> bool:
    """Whether the pieces of a tokenizer never hold or reach over white space, so that words are cut apart from each other."""
    if tokenizer.pre_tokenizer is None:
        return False
    text = "a b\nc  d"
    covered = {i for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(text) for i in range(start, end)}
    return not any(text[i].isspace() for i in covered)


def first_ids(tokenizer, texts: list[str], n: int, chars: int = CHARS) -> list[list[int]]:
    """The first ``n`` ids of every text, which is read only as far as they reach.

    A text is cut before a space or line break; if its beginning has too few ids, a longer one is read, up to the whole.
    """
    out: list[list[int]] = [[] for _ in texts]
    todo, whole = list(range(len(texts))), not parts_at_spaces(tokenizer)
    while todo:
        ends = [len(texts[i]) if whole or len(texts[i]) <= chars else
                max(texts[i].rfind(" ", 0, chars), texts[i].rfind("\n", 0, chars)) for i in todo]
        found = tokenizer.encode_batch([texts[i][:max(e, 0)] for i, e in zip(todo, ends, strict=True)], add_special_tokens=False)
        left = []
        for i, e, f in zip(todo, ends, found, strict=True):
            out[i] = f.ids[:n]
            if len(f.ids) < n and e < len(texts[i]):
                left.append(i)
        todo, chars = left, 4 * chars
    return out


def contextual_encoder(spark: SparkSession, weights: str, tokenizer: str, start_id: int, end_id: int,
                       max_subwords: int = MAX_SUBWORDS) -> Callable:
    """A ``make_encoder`` for ``encode_text``: ``start_id``, the text's subwords and ``end_id``, cut at ``max_subwords``.

    Null and empty texts are the two marks alone. ``weights`` and ``tokenizer`` are paths that Spark can fetch.
    """
    for path in (weights, tokenizer):
        spark.sparkContext.addFile(path)
    names = [os.path.basename(p) for p in (weights, tokenizer)]

    def make():
        from tokenizers import Tokenizer

        encoder = Encoder(dict(np.load(SparkFiles.get(names[0]))))
        cut = Tokenizer.from_file(SparkFiles.get(names[1]))

        def predict(texts: np.ndarray) -> np.ndarray:
            found = first_ids(cut, [str(t or "") for t in texts], max_subwords - 2)
            return encoder.encode([[start_id, *ids, end_id] for ids in found])
        return predict
    return make
