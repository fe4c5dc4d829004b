"""Scoring texts with a causal self-attention language model.

The model reads subword ids of a public vocabulary (lower-cased words, each
with the space before it): one attention layer with relative positions over a
short window and a two-level softmax (class, then member). It starts from steps
over a small sample on the driver and then learns from every other training
document once: in each of ``ROUNDS`` rounds the tasks take steps over their own
documents of that round, all from the same parameters, and the mean of what they
reach, weighted by windows, starts the next round (local steps with averaging:
Lin et al. 2018, "Don't use large mini-batches, use local SGD"). A text is scored
in overlapping windows, each id once, with a batch of windows in one masked
attention.

A word's probability is the product of its ids' probabilities, mixed with its
share of all words of the training corpus; the mixture's weight is fitted on
sampled documents that the network has not seen, their own words left out of
the counts. The counts are of the whole corpus: the ``TOP_WORDS`` most
frequent words are sent to all tasks, all other words meet their counts in a
join, so the size of the vocabulary is not bounded.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, fold_col, map_batches, small_batches, words, written
from tidemark.llm.tokens import load_encoding

FIT_DOCS = 800           # training documents the network starts from, the lowest by a hash; all others follow in rounds
STEPS, WINDOWS = 1200, 192   # the start's optimiser steps; windows in a step
ROUNDS = 4               # rounds over all other training documents, each of which comes in one of them
ROUND_RATE = 1e-3        # rate of the first round's steps
HELD_IDS = 200_000       # ids of documents a task holds to draw its steps from
TOP_WORDS = 150_000      # most frequent words sent to all tasks (about 4 MB)
CACHE_WORDS = 250_000    # words whose ids a Python worker keeps
FLUSH_WORDS = 300_000    # distinct words a task counts before passing them on
WINDOW, STRIDE = 16, 12  # ids read, and ids scored, in a window
CLASSES, MEMBERS = 32, 32
WIDTH, KEY_WIDTH = 24, 16
BATCH_IDS = 8_000       # ids in a batch of windows: its arrays stay in a core's cache
END, RARE = 0, 1         # numbers of the end (also the start) and of all ids outside the network's vocabulary
HELD_OUT = 10            # crc32 of the id modulo this is 0: held out


class Vocabulary:
    """The network's numbers of subword ids: the most frequent ones of the sample, by frequency."""

    def __init__(self, ids: list[int], size: int, path: str | None = None):
        self.ids, self.size, self.path = ids, size, path
        self._encode = load_encoding(path).encode_ordinary
        self._number = np.full(size, RARE, np.uint16)
        self._number[ids] = np.arange(2, 2 + len(ids), dtype=np.uint16)
        self.rare_logp = -np.log(max(1, size - len(ids)))      # each id outside is as likely

    def numbers(self, word: bytes) -> bytes:
        return self._number[self._encode(" " + word.decode("utf-8", "surrogatepass"))].tobytes()


class _Numbers(dict):
    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._of = vocabulary.numbers

    def __missing__(self, word: bytes) -> bytes:
        out = self._of(word)
        if len(self) < CACHE_WORDS:
            self[word] = out
        return out


@lru_cache(maxsize=1)
def known_numbers(ids: tuple[int, ...], size: int, path: str | None) -> _Numbers:
    """Words' numbers, kept by a Python worker for its next task with the same vocabulary."""
    return _Numbers(Vocabulary(list(ids), size, path))


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end with the given numbers of predictions: the places each window
    reads (-1 before a text's start and after its end), the places its last ``STRIDE`` ids have
    in the text's own order, and which of them exist. Every place is scored once."""
    n = -(-lengths // STRIDE)
    first = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), n)
    start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    own = start[:, None] - (WINDOW - STRIDE) + np.arange(WINDOW)
    exists = (own >= 0) & (own < lengths[text][:, None])
    read = np.where(exists, first[text][:, None] + own, -1)
    return read, read[:, WINDOW - STRIDE:], exists[:, WINDOW - STRIDE:]


def inputs(numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What precedes each number in its text (the end before the first), and one end more, for places outside."""
    before = np.append(numbers, END).astype(numbers.dtype)
    before[1:-1] = numbers[:-1]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = END
    return before


_DISTANCE = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_CAUSAL = np.where(_DISTANCE >= 0, 0.0, -1e9).astype(np.float32)


class Network:
    """Parameters, and tables of every number's query, key, value and residual."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        e = p["E"]
        self.q = (e @ p["Wq"] / np.sqrt(KEY_WIDTH)).astype(np.float32)
        self.k, self.v, self.r = e @ p["Wk"], e @ p["Wv"], e @ p["Wr"]
        self.bias = p["b"][np.maximum(_DISTANCE, 0)] + _CAUSAL

    @staticmethod
    def new(unigram: np.ndarray, rng: np.random.Generator) -> Network:
        """``unigram``: counts of the numbers, for the starting output biases."""
        v = CLASSES * MEMBERS
        f = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        c = np.zeros(v)
        c[:len(unigram)] = unigram
        c = c.reshape(CLASSES, MEMBERS) + 0.5
        return Network({"E": f(v, WIDTH), "Wq": f(WIDTH, KEY_WIDTH), "Wk": f(WIDTH, KEY_WIDTH),
                        "Wv": f(WIDTH, WIDTH), "Wr": f(WIDTH, WIDTH) + np.eye(WIDTH, dtype=np.float32),
                        "b": np.zeros(WINDOW, np.float32),
                        "Uc": f(WIDTH, CLASSES), "bc": np.log(c.sum(1) / c.sum()).astype(np.float32),
                        "Um": f(CLASSES, WIDTH, MEMBERS),
                        "bm": np.log(c / c.sum(1, keepdims=True)).astype(np.float32)})

    def attend(self, x: np.ndarray, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hidden states of the windows' ids from ``first`` on, and their attention to all."""
        mine = x[:, first:]
        s = self.q[mine] @ self.k[x].transpose(0, 2, 1)
        s += self.bias[first:]
        np.exp(np.minimum(s, 60, out=s), out=s)
        s /= (s @ _ONES[:WINDOW])[..., None]
        h = s @ self.v[x]
        h += self.r[mine]
        return h, s

    def members(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of rows in order of their class (class i: those from ``at[i]``), every member's logit within it."""
        z = np.empty((len(h), MEMBERS), h.dtype)
        for i, (a, b) in enumerate(pairwise(at.tolist())):
            if a < b:
                np.dot(h[a:b], self.p["Um"][i], out=z[a:b])
                z[a:b] += self.p["bm"][i]
        return z

    def logp(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probability of each target."""
        order, at = by_class(y)
        h, y, rows = h[order], y[order], np.arange(len(y))
        out = np.empty(len(y), h.dtype)
        value = 0
        for z, target in ((h @ self.p["Uc"] + self.p["bc"], y // MEMBERS), (self.members(h, at), y % MEMBERS)):
            value += z[rows, target]
            value -= np.log(np.exp(z, out=z) @ _ONES)
        out[order] = value
        return out

    def score(self, numbers: np.ndarray, lengths: np.ndarray, rare_logp: float) -> np.ndarray:
        """Log probability of every number of texts laid end to end (each text's own end included)."""
        before = inputs(numbers, lengths)
        read, places, exists = windows(lengths)
        out = np.empty(len(numbers))
        step = max(1, BATCH_IDS // WINDOW)
        for i in range(0, len(read), step):
            h, _ = self.attend(before[read[i:i + step]], WINDOW - STRIDE)
            keep = exists[i:i + step]
            target = places[i:i + step][keep]
            y = numbers[target].astype(np.int64)
            out[target] = self.logp(h[keep], y) + np.where(y == RARE, rare_logp, 0.0)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, used: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the used targets, and its gradients. Queries, keys, values and residuals depend on the
        number alone: they are made once for every number."""
        p, scale, x = self.p, np.float32(1 / np.sqrt(KEY_WIDTH)), x.astype(np.intp)
        wqr, wkv = np.concatenate([p["Wq"] * scale, p["Wr"]], 1), np.concatenate([p["Wk"], p["Wv"]], 1)
        first = int(used.any(0).argmax())          # no targets before: no queries either
        used = used[:, first:]
        qr, kv = (p["E"] @ wqr).take(x[:, first:], 0), (p["E"] @ wkv).take(x, 0)
        q, k, v = qr[..., :KEY_WIDTH], kv[..., :KEY_WIDTH], kv[..., KEY_WIDTH:]
        a = q @ k.transpose(0, 2, 1)
        a += self.bias[first:]
        np.exp(np.minimum(a, 60, out=a), out=a)
        a /= (a @ _ONES[:WINDOW])[..., None]
        h = a @ v
        h += qr[..., KEY_WIDTH:]

        place = np.flatnonzero(used)
        ys = y[:, first:].ravel()[place].astype(np.int64)
        order, at = by_class(ys)
        place, ys = place[order], ys[order]
        hs = h.reshape(-1, WIDTH).take(place, 0)
        n, c, m = len(ys), ys // MEMBERS, ys % MEMBERS
        rows, loss = np.arange(n), 0.0
        pc, pm = hs @ p["Uc"] + p["bc"], self.members(hs, at)
        for z, target in ((pc, c), (pm, m)):
            if max(z.max(), -z.min()) > 60:
                z -= z.max(-1, keepdims=True)
            loss -= z[rows, target].sum(dtype=float)
            total = np.exp(z, out=z) @ _ONES
            loss += np.log(total).sum(dtype=float)
            z *= (np.float32(1 / n) / total)[:, None]
            z[rows, target] -= np.float32(1 / n)
        g = {"Uc": hs.T @ pc, "bc": np.ones(n, np.float32) @ pc, "Um": np.zeros_like(p["Um"]), "bm": np.zeros_like(p["bm"])}
        dhm = np.empty_like(hs)
        for i, (lo, hi) in enumerate(pairwise(at.tolist())):
            if lo < hi:
                np.dot(hs[lo:hi].T, pm[lo:hi], out=g["Um"][i])
                np.dot(pm[lo:hi], p["Um"][i].T, out=dhm[lo:hi])
        present = np.flatnonzero(np.diff(at))
        g["bm"][present] = np.add.reduceat(pm, at[present], 0)

        dqr = np.zeros_like(qr)
        dqr.reshape(-1, KEY_WIDTH + WIDTH)[place, KEY_WIDTH:] = pc @ p["Uc"].T + dhm
        dh = dqr[..., KEY_WIDTH:]
        ds = dh @ v.transpose(0, 2, 1)
        ds -= ((ds * a) @ _ONES[:WINDOW])[..., None]
        ds *= a
        np.matmul(ds, k, out=dqr[..., :KEY_WIDTH])
        dkv = np.empty_like(kv)
        np.matmul(ds.transpose(0, 2, 1), q, out=dkv[..., :KEY_WIDTH])
        np.matmul(a.transpose(0, 2, 1), dh, out=dkv[..., KEY_WIDTH:])
        flat = lambda t: t.reshape(-1, t.shape[-1])
        e, dqr, dkv = p["E"].take(x, 0), flat(dqr), flat(dkv)
        de = (dkv @ wkv.T).reshape(e.shape)
        de[:, first:] += (dqr @ wqr.T).reshape(*used.shape, WIDTH)
        dwqr, dwkv = flat(e[:, first:]).T @ dqr, flat(e).T @ dkv
        g |= {"E": sums_by(x.ravel(), flat(de), len(p["E"])), "Wq": dwqr[:, :KEY_WIDTH] * scale, "Wr": dwqr[:, KEY_WIDTH:],
              "Wk": dwkv[:, :KEY_WIDTH], "Wv": dwkv[:, KEY_WIDTH:],
              "b": np.bincount(np.maximum(_DISTANCE[first:], 0).ravel(), ds.sum(0).ravel(), WINDOW).astype(ds.dtype)}
        return loss / n, g


_ONES = np.ones(max(WINDOW, CLASSES, MEMBERS), np.float32)


def by_class(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the targets by class, and where in it each class starts (and the last ends)."""
    c = (y // MEMBERS).astype(np.uint8)
    return np.argsort(c, kind="stable"), np.append(0, np.cumsum(np.bincount(c, minlength=CLASSES)))


def sums_by(x: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``d`` that have the same number in ``x``, for the numbers below ``n``."""
    width = d.shape[1]
    cell = (x[:, None] * width + np.arange(width)).ravel()
    return np.bincount(cell, d.ravel(), n * width).reshape(n, width).astype(d.dtype)


def train(texts: list[np.ndarray], steps: int = STEPS, batch: int = WINDOWS, rate: float = 4e-3,
          seed: int = 1) -> Network:
    """Adam on random windows of the texts (numbers, without the end). The number of steps is
    fixed, so training costs the same over any table."""
    rng = np.random.default_rng(seed)
    texts = [np.append(t, END).astype(np.uint16) for t in texts] or [np.array([END], np.uint16)]
    numbers, lengths = np.concatenate(texts), np.array([len(t) for t in texts])
    before = inputs(numbers, lengths)
    read, places, exists = windows(lengths)
    used = np.zeros(read.shape, bool)
    used[:, WINDOW - STRIDE:] = exists
    net = Network.new(np.bincount(numbers, minlength=CLASSES * MEMBERS), rng)
    adam = Adam(net)
    for t in range(1, steps + 1):
        rows = rng.integers(0, len(read), batch)
        adam.step(before[read[rows]], numbers[read[rows]], used[rows], rate * (1 - 0.95 * t / steps))
    return Network(net.p)


class Adam:
    """Optimiser of a network's parameters, in place: they lie one after another in one array."""

    def __init__(self, net: Network):
        self.net, self.t = net, 0
        self.all = np.concatenate([v.ravel() for v in net.p.values()])
        at = np.cumsum([0, *(v.size for v in net.p.values())]).tolist()
        net.p = {k: self.all[a:b].reshape(v.shape) for (k, v), (a, b) in zip(net.p.items(), pairwise(at), strict=True)}
        self.first, self.second = np.zeros_like(self.all), np.zeros_like(self.all)

    def step(self, x: np.ndarray, y: np.ndarray, used: np.ndarray, rate: float) -> None:
        net, first, second = self.net, self.first, self.second
        self.t += 1
        _, g = net.gradients(x, y, used)
        lr = rate * min(1.0, self.t / 50)
        v = np.concatenate([g[k].ravel() for k in net.p])
        first += 0.1 * (v - first)
        second += 0.01 * (v * v - second)
        self.all -= lr * (first / (1 - 0.9 ** self.t)) / (np.sqrt(second / (1 - 0.99 ** self.t)) + 1e-8)
        net.bias = net.p["b"][np.maximum(_DISTANCE, 0)] + _CAUSAL


def train_on(net: Network, texts: list[np.ndarray], adam: Adam, rng: np.random.Generator, rate: float,
             batch: int = WINDOWS) -> int:
    """Steps over every window of the texts (numbers, without the end) once, in random order; the windows' number."""
    texts = [np.append(t, END).astype(np.uint16) for t in texts]
    numbers, lengths = np.concatenate(texts), np.array([len(t) for t in texts])
    before = inputs(numbers, lengths)
    read, _, exists = windows(lengths)
    used = np.zeros(read.shape, bool)
    used[:, WINDOW - STRIDE:] = exists
    order = rng.permutation(len(read))
    for i in range(0, len(order), batch):
        rows = order[i:i + batch]
        adam.step(before[read[rows]], numbers[read[rows]], used[rows], rate * len(rows) / batch)
    return len(order)


FIXED = 1 << 20          # parameters are averaged in whole multiples of 1 / FIXED, so in any order alike


def train_round(docs: DataFrame, net: Network, vocabulary: Vocabulary, rate: float) -> Network:
    """The mean, weighted by windows, of the networks the tasks reach from ``net`` by steps over their ``docs``.

    A task sends one row for each parameter; Spark adds them up cell by cell.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.ids, vocabulary.size, vocabulary.path, net.p))
    names = sorted(net.p)

    def run(batches):
        ids, size, path, p = shared.value
        numbers = known_numbers(tuple(ids), size, path)
        mine = Network({k: v.copy() for k, v in p.items()})
        adam, rng, held, n_ids, n = Adam(mine), np.random.default_rng(1), [], 0, 0
        for b in batches:
            for text in b["text"]:
                held.append(np.frombuffer(b"".join(numbers[w] for w in words(text)), np.uint16))
                n_ids += len(held[-1]) + 1
                if n_ids >= HELD_IDS:
                    n += train_on(mine, held, adam, rng, rate)
                    held, n_ids = [], 0
        if held:
            n += train_on(mine, held, adam, rng, rate)
        if n:
            change = np.concatenate([(mine.p[k] - p[k]).ravel() for k in names]).astype(float)
            yield {"cell": np.arange(-1, len(change)), "v": np.append(n, np.rint(change * FIXED).astype(np.int64) * n)}

    cells = (map_batches(docs.select("text"), run, "cell long, v long").groupBy("cell")
             .agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("double").alias("v")).toArrow())
    if not cells.num_rows:
        return net
    cell, v = cells.column("cell").to_numpy(), cells.column("v").to_numpy()
    total = v[np.argsort(cell)]
    change, at, out = total[1:] / total[0] / FIXED, 0, {}
    for k in names:
        out[k] = (net.p[k] + change[at:at + net.p[k].size].reshape(net.p[k].shape)).astype(np.float32)
        at += net.p[k].size
    return Network(out)


def id_counts(counts: DataFrame, tokenizer: str | None) -> DataFrame:
    """``id, n``: how often each id occurs in all training texts, from the counts of their words."""
    def run(batches):
        encode = load_encoding(tokenizer).encode_ordinary
        seen: Counter = Counter()
        for b in batches:
            for word, n in zip(b["word"], b["n"], strict=True):
                for i in encode(" " + word.decode("utf-8", "surrogatepass")):
                    seen[i] += n
        yield {"id": list(seen), "n": list(seen.values())}

    return map_batches(counts, run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    vocabulary: list[int]
    vocabulary_size: int
    path: str | None
    p: dict[str, np.ndarray]
    weight: float            # of the network in the mixture with the corpus' word shares
    top: dict[bytes, int]    # counts of the most frequent words
    tokens: int              # N: training words and ends
    distinct: int            # V: distinct ones
    documents: int           # training documents, the end's count


def word_counts(rows: DataFrame) -> DataFrame:
    """``word (binary), n`` over all texts, counted in the tasks first."""
    def run(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                seen.update(words(t))
            if len(seen) > FLUSH_WORDS:
                yield {"word": list(seen), "n": list(seen.values())}
                seen = Counter()
        yield {"word": list(seen), "n": list(seen.values())}

    return map_batches(rows.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def mixture_weight(lm: np.ndarray, share: np.ndarray, rounds: int = 30) -> float:
    """The weight of ``exp(lm)`` against ``share`` that makes the words likeliest (EM)."""
    w, p = 0.3, np.exp(np.maximum(lm, -700))
    if not len(lm):
        return w
    for _ in range(rounds):
        w = float(np.mean(w * p / (w * p + (1 - w) * share + 1e-320)))
        w = min(0.99, max(0.01, w))
    return w


def word_logp(net: Network, vocabulary: Vocabulary, numbers: _Numbers,
              split: list[list[bytes]]) -> list[np.ndarray]:
    """For each text the network's log probability of each of its words and of its end."""
    pieces = [[numbers[w] for w in ws] for ws in split]
    end = np.array([END], np.uint16).tobytes()
    flat = np.frombuffer(b"".join(x for ps in pieces for x in (*ps, end)), np.uint16)
    sizes = [np.array([len(x) for x in ps] + [2]) // 2 for ps in pieces]
    lengths = np.array([s.sum() for s in sizes])
    logp = net.score(flat, lengths, vocabulary.rare_logp)
    starts = np.cumsum(np.concatenate(sizes)) - np.concatenate(sizes)
    sums = np.add.reduceat(logp, starts)
    return np.split(sums, np.cumsum([len(s) for s in sizes])[:-1])


def fit(docs: DataFrame, counts: DataFrame, max_docs: int = FIT_DOCS, top_words: int = TOP_WORDS,
        tokenizer: str | None = None, steps: int = STEPS, rounds: int = ROUNDS) -> Model:
    """Fit on ``docs`` (``doc_id, text``), whose words have the given ``counts``.

    The network starts from about ``max_docs`` documents at most, of which
    each eighth serves for the mixture's weight alone, and goes on over all
    other documents in rounds.
    """
    n_docs = docs.count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()[0]
    top = counts.orderBy(F.col("n").desc(), "word").limit(top_words).toArrow()
    top = dict(zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True))
    share = int((1 << 20) * min(1.0, max_docs / max(n_docs, 1)))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20))
    sample = docs.where(place < share).select("doc_id", "text").limit(2 * max_docs).collect()
    split = [words(r.text) for r in sorted(sample, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))]
    learn, tune = [s for i, s in enumerate(split) if i % 8], split[::8]

    encoding = load_encoding(tokenizer)
    kept = [r.id for r in id_counts(counts, tokenizer).orderBy(F.desc("n"), "id").limit(CLASSES * MEMBERS - 2).collect()]
    vocabulary = Vocabulary(kept, encoding.n_vocab, tokenizer)
    numbers = _Numbers(vocabulary)
    net = train([np.frombuffer(b"".join(numbers[w] for w in ws), np.uint16) for ws in learn], steps)
    if n_docs > len(sample):
        turn = F.pmod(F.xxhash64("text", "doc_id"), F.lit(rounds))
        for r in range(rounds):
            net = train_round(docs.where((place >= share) & (turn == r)), net, vocabulary, ROUND_RATE * (1 - 0.9 * r / rounds))

    own: Counter = Counter(w for ws in tune for w in ws)
    spark = docs.sparkSession
    asked = spark.createDataFrame([(w,) for w in own if w not in top], "word binary")
    known = top | {bytes(r.word): r.n for r in counts.join(F.broadcast(asked), "word").collect()}
    n = (total.n or 0) + n_docs
    lm = word_logp(net, vocabulary, numbers, tune) if tune else []
    flat = [(x, max(0, known.get(w, 0) - 1) / max(n, 1)) for ws, xs in zip(tune, lm, strict=True)
            for w, x in zip(ws, xs[:-1].tolist(), strict=True)]
    weight = mixture_weight(np.array([f[0] for f in flat]), np.array([f[1] for f in flat]))
    return Model(kept, encoding.n_vocab, tokenizer, net.p, weight, top, n, total.v + (n_docs > 0), n_docs)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``doc_id, text``.

    ``base_score``: smoothed shares of the training corpus; ``score``: the
    model's log10 probability of the text. Null and empty texts are one end.
    Null ids belong to the fold of the empty text; repeated rows get a row
    each. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    log10 = float(np.log(10))
    space = model.tokens + 0.1 * (model.distinct + 1)
    n_all, weight = float(max(model.tokens, 1)), model.weight
    names = ("uid", "word", "lm", "doc_id", "n_tokens", "n_known", "base", "score")

    def run(batches):
        m = shared.value
        vocabulary, net = Vocabulary(m.vocabulary, m.vocabulary_size, m.path), Network(m.p)
        numbers, top = known_numbers(tuple(m.vocabulary), m.vocabulary_size, m.path), m.top
        waiting: list[tuple[int, int | None, list[bytes]]] = []
        size = 0

        def finish():
            out = {c: [] for c in names}
            for (uid, doc, ws), lm in zip(waiting, word_logp(net, vocabulary, numbers, [x[2] for x in waiting]),
                                          strict=True):
                c = np.fromiter(map(top.get, ws, repeat(0)), np.float64, len(ws))
                c = np.append(c, m.documents)
                sure = c > 0
                sure[-1] = True
                base = np.log10((c[sure] + 0.1) / space).sum()
                mixed = np.where(c[sure] > 0, np.log10(weight * np.exp(lm[sure]) + (1 - weight) * c[sure] / n_all
                                                      + 1e-320), np.log10(weight) + lm[sure] / log10).sum()
                # A key no word can have (words hold no spaces), different for each document.
                for col, v in zip(names, (uid, b" %d" % uid, 0.0, doc, len(c), int((c > 0).sum()), base, mixed),
                                  strict=True):
                    out[col].append(v)
                rest = np.flatnonzero(~sure).tolist()
                out["uid"] += [uid] * len(rest)
                out["word"] += [ws[i] for i in rest]
                out["lm"] += lm[rest].tolist()
                for col in names[3:]:
                    out[col] += [None] * len(rest)
            return out

        for b in batches:
            for uid, doc, text in zip(b["uid"], b["doc_id"], b["text"], strict=True):
                waiting.append((uid, doc, words(text)))
                size += len(text or "") + 50
                if size > 400_000:
                    yield finish()
                    waiting, size = [], 0
        if waiting:
            yield finish()

    rows = map_batches(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), run,
                       "uid long, word binary, lm double, doc_id long, n_tokens long, n_known long, base double, "
                       "score double")
    c = F.col("n")
    own = F.col("n_tokens").isNotNull()
    network = F.lit(float(np.log10(weight))) + F.col("lm") / log10
    mixed = F.when(c.isNull(), network).otherwise(
        F.log10(F.lit(weight) * F.exp("lm") + F.lit(1 - weight) * c / n_all))
    joined = rows.join(counts, "word", "left").select(
        "uid", "doc_id", "n_tokens",
        F.when(own, F.col("n_known")).otherwise(F.when(c.isNull(), 0).otherwise(1)).alias("n_known"),
        F.when(own, F.col("base")).otherwise(F.log10((F.coalesce(c, F.lit(0)) + 0.1) / space)).alias("base"),
        F.when(own, F.col("score")).otherwise(mixed).alias("score"))
    out = joined.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return out.select("doc_id", (fold_col("doc_id", HELD_OUT) == 0).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Learn from the documents outside the held-out fold, score all."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    learn = rows.where(fold_col("doc_id", HELD_OUT) != 0)
    counts = written(word_counts(learn), "lm-counts")
    return score(rows, fit(learn, counts, **options), counts)


__all__ = ["Model", "Network", "fit", "fit_and_score", "fold", "mixture_weight", "score", "train", "windows",
           "word_counts"]
