"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces of the
product of their probabilities (forward algorithm); a text's score is the sum
of its words' log probabilities. Piece probabilities are fitted per language
by expectation maximisation on the words of a bounded sample of labelled
documents of each language: in every round tasks add up the expected counts of
their words, whatever the language, and Spark sums them piece by piece.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_col, map_batches, small_batches, written

FIT_DOCS = 1500          # labelled documents of a language to fit on, a share by a hash of id and text
EM_ROUNDS = 4
STRETCH = 40             # longer words are learned in stretches of so many characters (and scored whole)
HELD_WORDS = 30_000      # words of a language that a task gathers before it counts their pieces
RESCALE = 24             # characters after which a long word's forward values are scaled
CACHE_WORDS = 250_000    # scored words kept per task (about 60 MB)
UNKNOWN = 1e-7           # probability of a character outside the vocabulary
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"        # the vocabulary's mark of a word's start
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def vocabulary(path: str | None = None) -> list[str]:
    """All lower-cased letter pieces of the public vocabulary (default: ``piece_bpe_32k.model``)."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    return sorted(p for p in pieces if _LETTERS.fullmatch(p.removeprefix(_START)))


def _codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class Lattice:
    """Piece numbers of every substring of words of one length, found by a rolling hash."""

    def __init__(self, pieces: list[str]):
        self.reach = max(map(len, pieces), default=1)
        with np.errstate(over="ignore"):
            hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        lengths = np.array([len(p) for p in pieces], np.int64)
        self._by_length = []                               # hashes of the pieces of each length, and their numbers
        for k in range(1, self.reach + 1):
            own = np.flatnonzero(lengths == k)
            own = own[np.argsort(hashes[own])]
            self._by_length.append((hashes[own], own.astype(np.int32)))
        self.size = len(pieces)

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = np.uint64(0)
        for c in _codes(piece):
            h = h * _BASE + c
        return h

    def of(self, found: list[str]) -> np.ndarray:
        """``[k, word, end]``: the piece of ``k + 1`` characters ending at ``end``, or ``size``."""
        n, length = len(found), len(found[0])
        codes = _codes("".join(found)).reshape(n, length)
        out = np.full((self.reach, n, length), self.size, np.int32)
        with np.errstate(over="ignore"):
            h = np.zeros((n, length), np.uint64)
            for k in range(min(self.reach, length)):
                # hash of k + 1 characters: the one of the k before the last, times the base, plus the last
                shifted = np.zeros_like(h)
                shifted[:, 1:] = h[:, :-1]
                h = shifted * _BASE + codes
                known, number = self._by_length[k]
                if len(known):
                    at = np.minimum(np.searchsorted(known, h[:, k:]), len(known) - 1)
                    hit = known[at] == h[:, k:]
                    out[k, :, k:][hit] = number[at[hit]]
        return out


def _step(lattice: np.ndarray, p: np.ndarray, before, end: int) -> np.ndarray:
    """Forward values after ``end``; ``before(k)``: those ``k + 1`` characters before it."""
    none = len(p) - 1
    number = lattice[0, :, end]
    q = p[number]
    q[number == none] = UNKNOWN
    out = before(0) * q
    for k in range(1, min(len(lattice), end + 1)):
        rows = np.flatnonzero(lattice[k, :, end] != none)          # long pieces are rare
        if len(rows):
            out[rows] += before(k)[rows] * p[lattice[k, rows, end]]
    return out


def forward(lattice: np.ndarray, p: np.ndarray) -> np.ndarray:
    """``alpha[end, word, language]``: total probability of all segmentations up to ``end``.

    ``p[piece, language]``; the row after the last piece is 0, and a single
    character outside the vocabulary counts ``UNKNOWN``.
    """
    _, n, length = lattice.shape
    alpha = np.zeros((length + 1, n, p.shape[1]))
    alpha[0] = 1.0
    for end in range(length):
        alpha[end + 1] = _step(lattice, p, lambda k, end=end: alpha[end - k], end)
    return alpha


def log_total(lattice: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log probability of whole words of any length, summed over all segmentations: ``[word, language]``.

    Only the last values are kept; they are scaled from time to time, so that long words do not vanish.
    """
    reach, n, length = lattice.shape
    last, scale = [np.ones((n, p.shape[1]))], np.zeros((n, p.shape[1]))
    for end in range(length):
        last = [*last[-reach:], _step(lattice, p, lambda k: last[-1 - k], end)]
        if (end + 1) % RESCALE == 0:
            top = np.maximum(np.max(last, axis=0), 1e-300)
            last = [a / top for a in last]
            scale += np.log(top)
    return np.log(np.maximum(last[-1], 1e-300)) + scale


def _by_length(found: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(found):
        groups.setdefault(len(w), []).append(i)
    for length, rows in groups.items():
        step = max(1, 400_000 // (length + 1))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            yield np.array(part), [found[i] for i in part]


def expected_counts(found: list[str], counts: np.ndarray, lattice: Lattice, p: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece over all segmentations of the words (one language)."""
    expected = np.zeros(lattice.size + 1)
    for rows, ws in _by_length(found):
        lat = lattice.of(ws)
        reach, n, length = lat.shape
        alpha = forward(lat, p[:, None])[:, :, 0]
        beta = np.zeros((length + 1, n))
        beta[length] = 1.0
        for start in range(length - 1, -1, -1):
            for k in range(min(reach, length - start)):
                number = lat[k, :, start + k]
                use = slice(None) if k == 0 else np.flatnonzero(number != lattice.size)
                q = p[number[use]]
                if k == 0:
                    q[number == lattice.size] = UNKNOWN
                beta[start][use] += q * beta[start + k + 1][use]
        scale = counts[rows] / alpha[length]
        for end in range(length):
            for k in range(min(reach, end + 1)):
                number = lat[k, :, end]
                use = np.flatnonzero(number != lattice.size)
                if len(use):
                    number = number[use]
                    weight = alpha[end - k][use] * p[number] * beta[end + 1][use] * scale[use]
                    expected += np.bincount(number, weight, lattice.size + 1)
    return expected


def maximised(expected: np.ndarray) -> np.ndarray:
    """Piece probabilities from expected counts; every piece keeps a little."""
    p = expected + 0.01
    p[-1] = 0.0
    return p / p.sum()


def uniform(size: int) -> np.ndarray:
    return np.append(np.full(size, 1.0 / max(size, 1)), 0.0)


def fit_language(found: list[str], counts: np.ndarray, lattice: Lattice, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece probabilities by expectation maximisation over all segmentations, in one place."""
    p = uniform(lattice.size)
    for _ in range(rounds):
        p = maximised(expected_counts(found, counts, lattice, p))
    return p


def split_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, marked at the start."""
    return [_START + w for w in _LETTERS.findall(text.lower())] if text else []


def stretches_of(word: str) -> list[str]:
    """A word in stretches of at most ``STRETCH`` characters."""
    return [word[i:i + STRETCH] for i in range(0, len(word), STRETCH)] if len(word) > STRETCH else [word]


class Model:
    """Languages (sorted) and ``p[piece, language]``."""

    def __init__(self, languages: list[str], p: np.ndarray, pieces: list[str]):
        self.languages, self.p, self.pieces = languages, p, pieces


def fit(labelled: DataFrame, max_docs: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", pieces: list[str] | None = None, rounds: int = EM_ROUNDS) -> Model:
    """Fit on about ``max_docs`` labelled rows of each language at most (a share by a hash of id and text, so that
    a rare language has all its rows in). Rows without text or label are left out.

    What comes to the driver is piece counts: vocabulary times languages.
    """
    pieces = pieces or vocabulary()
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((len(pieces) + 1, 0)), pieces)
    share = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, max_docs / n))])
    rows = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches):
        found: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                found.setdefault(lang, Counter()).update(w for x in split_words(text) for w in stretches_of(x))
            if sum(map(len, found.values())) > CACHE_WORDS:
                yield _flat(found)
                found = {}
        yield _flat(found)

    def _flat(found):
        flat = [(lang, w, c) for lang, ws in found.items() for w, c in ws.items()]
        return dict(zip(("lang", "word", "n"), map(list, zip(*flat, strict=True)), strict=True)) if flat else {
            "lang": [], "word": [], "n": []}

    counted = written(map_batches(rows.select("lang", "text"), count, "lang string, word string, n long")
                      .groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    of = {lang: i for i, lang in enumerate(languages)}
    p = np.repeat(uniform(len(pieces))[:, None], len(languages), axis=1)
    for _ in range(rounds):
        shared = labelled.sparkSession.sparkContext.broadcast(p)

        def expect(batches, shared=shared):
            lattice, now = Lattice(pieces), shared.value
            total: dict[str, np.ndarray] = {}
            held: dict[str, tuple[list, list]] = {}

            def settle(lang: str) -> None:
                words, n = held.pop(lang)
                total[lang] = total.get(lang, 0.0) + expected_counts(words, np.array(n, float), lattice, now[:, of[lang]])

            for b in batches:
                for lang, word, n in zip(b["lang"], b["word"], b["n"], strict=True):
                    words, counts = held.setdefault(lang, ([], []))
                    words.append(word)
                    counts.append(n)
                # Many words at a time: words of one length share their steps.
                for lang in [x for x, (words, _) in held.items() if len(words) > HELD_WORDS]:
                    settle(lang)
            for lang in list(held):
                settle(lang)
            for lang, v in total.items():
                at = np.flatnonzero(v)
                yield {"lang": [lang] * len(at), "piece": at.tolist(), "v": v[at].tolist()}

        found = (map_batches(counted, expect, "lang string, piece int, v double").groupBy("lang", "piece")
                 .agg(F.sum("v").alias("v")).toArrow())
        expected = np.zeros_like(p)
        lang = np.array([of[x] for x in found.column("lang").to_pylist()], np.int64)
        expected[found.column("piece").to_numpy(), lang] = found.column("v").to_numpy()
        p = np.stack([maximised(e) for e in expected.T], axis=1)
    return Model(languages, p, pieces)


class Scorer:
    """Scores texts with a fitted model; keeps the scores of words seen in its task."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)

    def _learn(self, new: list[str]) -> None:
        scores = np.zeros((len(new), len(self.model.languages)), np.float32)
        for rows, ws in _by_length([_START + w for w in new]):
            scores[rows] = log_total(self.lattice.of(ws), self.model.p)
        self.index.update(zip(new, range(len(self.scores), len(self.scores) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, scores])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.index) > CACHE_WORDS:
            self._reset()
        split = [_LETTERS.findall(t.lower()) if t else [] for t in texts]
        if self.model.languages:
            self._learn(list(set().union(*split).difference(self.index)))
        langs, scores = [], []
        for ws in split:
            if not ws or not self.model.languages:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            at = np.fromiter(map(self.index.__getitem__, ws), np.int64, len(ws))
            total = self.scores[at].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            langs.append(self.model.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return langs, scores


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row.

    ``score`` is the posterior of the predicted language under equal priors.
    Null, empty and letterless texts: ``und`` with score 0. Long words and texts
    are scored whole, in time proportional to their length. Ties go to the
    first language by code point. Repeated rows and null ids: a row each.
    Empty table: no rows. Without any labelled row all is ``und``.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.p, model.pieces))

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        for b in batches:
            langs, scores = scorer.predict(b["text"])
            yield {"doc_id": b["doc_id"], "lang_pred": langs, "score": scores}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run,
                       "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least ``min_score``, all columns kept."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.p, model.pieces))
    state: dict[str, Scorer] = {}

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        scorer = state.get("scorer")
        if scorer is None:
            scorer = state["scorer"] = Scorer(Model(*shared.value))
        langs, scores = scorer.predict([None if t is None else t for t in texts])
        return pd.Series([lang != UNDETERMINED and s >= min_score for lang, s in zip(langs, scores, strict=True)])

    return docs.where(kept(F.col(f"`{text_col}`")))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents outside the held-out fold (crc32 of the id modulo 5 is 0)."""
    return docs.where(fold_col(id_col, 5) != 0)
