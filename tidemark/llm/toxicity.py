"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps words to symbols (insult, threat, target, negation,
report); the insult, threat, negation and reported-speech transducers are
composed into one grammar whose best path weighs a clause. Insults are fixed
word lists plus word stems learned from labelled documents; only clauses with
an insult or a threat are weighed, never words by themselves. A logistic
model turns the clause weights of a document into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_col, map_batches, small_batches, written

FIT_TOXIC = 2500         # labelled documents to learn from, the lowest by a hash of their ids
FIT_CLEAN = 5000
STEM_CHARS = range(4, 9)  # prefix lengths of learned stems; whole words of any length besides
MAX_STEMS = 2000
CACHE_WORDS = 400_000
FEATURES = ("strongest", "total", "density", "clauses")

# Short public word lists in English, German, French and Spanish.
INSULTS = ("idiot moron imbecile scum stupid worthless pathetic "
           "trottel dummkopf abschaum blöd "
           "imbécile crétin ordure "
           "imbécil estúpido basura").split()
THREATS = ("kill hurt destroy beat shoot "
           "töten umbringen schlagen "
           "tuer frapper détruire "
           "matar golpear destruir").split()
TARGETS = ("you your they them he she him her people "
           "du dich dir ihr euch er sie "
           "tu toi vous il elle ils "
           "tú ti usted él ella ellos").split()
NEGATIONS = ("not never no isn't aren't don't "
             "nicht nie kein keine "
             "ne pas jamais "
             "nunca jamás").split()
REPORTS = ("said says called quoted wrote "
           "sagte nannte schrieb "
           "dit écrit appelé "
           "dijo llamó escribió").split()

# Symbols of the lexical transducer's output.
OTHER, INSULT, THREAT, TARGET, NEG, REPORT, BREAK = range(7)
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n\"“”«»]")
_BREAKS = frozenset(".!?;:\n")
_QUOTES = frozenset("\"“”«»")


@dataclass
class Transducer:
    """Arcs ``(state, symbol) -> (next state, output, weight)``; a missing arc
    keeps the state and passes the symbol on. ``final`` adds to the weight at the end."""

    arcs: dict[tuple[int, int], tuple[int, int, float]]
    final: dict[int, float] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, symbols: int = BREAK) -> Transducer:
    """The transducer that feeds ``first``'s output to ``second`` (pairs of states, weights added)."""
    number: dict[tuple[int, int], int] = {(0, 0): 0}
    todo, arcs, final = [(0, 0)], {}, {}
    while todo:
        a, b = todo.pop()
        here = number[a, b]
        final[here] = first.final.get(a, 0.0) + second.final.get(b, 0.0)
        for symbol in range(symbols):
            a2, mid, wa = first.step(a, symbol)
            b2, out, wb = second.step(b, mid)
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            arcs[here, symbol] = (number[a2, b2], out, wa + wb)
    return Transducer(arcs, final)


def grammar(reach: int = 3, negated: float = -0.8, reported: float = -0.5, directed: float = 0.3,
            threat: float = 1.0) -> Transducer:
    """Negation, report, insult and threat transducers composed, in that order.

    * negation: an insult or threat within ``reach`` words after a negation costs ``negated``;
    * reported speech: a report word or quotation mark anywhere before takes
      ``reported`` off an insult or threat;
    * insult: 1 each, and ``directed`` more with a target next to it;
    * threat: counts with a target after it.
    """
    away = {}
    for left in range(1, reach + 1):
        for symbol in (OTHER, TARGET, REPORT):
            away[left, symbol] = (left - 1, symbol, 0.0)
        for symbol in (INSULT, THREAT):
            away[left, symbol] = (left - 1, symbol, negated)
    for left in range(reach + 1):
        away[left, NEG] = (reach, NEG, 0.0)
    negation = Transducer(away)
    report = Transducer({(0, REPORT): (1, REPORT, 0.0), (1, INSULT): (1, INSULT, reported),
                         (1, THREAT): (1, THREAT, reported)})
    insult = Transducer({
        (0, TARGET): (1, TARGET, 0.0), (0, INSULT): (2, INSULT, 1.0),
        (1, INSULT): (2, INSULT, 1.0 + directed), (1, OTHER): (0, OTHER, 0.0), (1, NEG): (1, NEG, 0.0),
        (2, INSULT): (2, INSULT, 1.0), (2, TARGET): (1, TARGET, directed), (2, OTHER): (0, OTHER, 0.0)})
    threats = Transducer({(0, THREAT): (1, THREAT, 0.0), (1, TARGET): (0, TARGET, threat)})
    return compose(compose(compose(negation, report), insult), threats)


def table(g: Transducer) -> tuple[list[list[int]], list[list[float]]]:
    """The grammar as dense rows, state by symbol."""
    n = 1 + max(s for s, _ in g.arcs)
    return ([[g.step(s, y)[0] for y in range(BREAK)] for s in range(n)],
            [[g.step(s, y)[2] for y in range(BREAK)] for s in range(n)])


class Lexicon:
    """The lexical transducer: words to symbols, insults with their weights."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems})
        self._fixed = {}
        for symbol, listed in ((REPORT, REPORTS), (NEG, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS),
                               (INSULT, INSULTS)):
            self._fixed.update({w: (symbol, 0.25 if symbol == INSULT else 1.0) for w in listed})

    def __call__(self, token: str) -> tuple[int, float]:
        if token in _BREAKS:
            return BREAK, 0.0
        if token in _QUOTES:
            return REPORT, 0.0
        whole = self.stems.get(token + "$")
        if whole is not None:
            return INSULT, whole
        for n in self.lengths:
            if n > len(token):
                break
            weight = self.stems.get(token[:n])
            if weight is not None:
                return INSULT, weight
        return self._fixed.get(token, (OTHER, 0.0))


class Matcher:
    """Clause weights of whole texts; keeps the symbols of words seen in its task."""

    def __init__(self, stems: dict[str, float]):
        self.lexicon, (self.next, self.gain) = Lexicon(stems), table(grammar())
        outer = self

        class Seen(dict):
            def __missing__(self, token):
                symbol, weight = outer.lexicon(token)
                if weight:
                    outer.weights[token] = weight
                if len(self) < CACHE_WORDS:
                    self[token] = symbol
                return symbol

        self.weights: dict[str, float] = {}
        self.seen = Seen()

    def clauses(self, text: str | None) -> list[float]:
        """Positive weights of the clauses that hold an insult or a threat."""
        tokens = _TOKEN.findall(text.lower()) if text else []
        codes = bytes(map(self.seen.__getitem__, tokens))
        found, at = [], 0
        for clause in codes.split(bytes([BREAK])):
            if INSULT in clause or THREAT in clause:
                state, gain = 0, 0.0
                for symbol in clause:
                    gain += self.gain[state][symbol]
                    state = self.next[state][symbol]
                insults = [self.weights.get(tokens[at + i], 0.0) for i, s in enumerate(clause) if s == INSULT]
                weight = gain * (max(insults) if insults else 1.0)
                if weight > 0:
                    found.append(weight)
            at += len(clause) + 1
        return found

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        found = self.clauses(text)
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        n = len(text.split()) + 1
        return (max(found), float(np.log1p(sum(found))), min(4.0, 100.0 * sum(found) / n) / 4.0,
                float(np.log1p(len(found))))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """A bounded share of the labelled training rows: ``text, y, w``; text and label only.

    The sampled ids are few by the bounds above and go to all tasks, so no text is shuffled; the
    sample is written once.
    """
    y = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    n = {r.y: r.n for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = [min(1.0, FIT_CLEAN / max(n.get(0, 0), 1)), min(1.0, FIT_TOXIC / max(n.get(1, 0), 1))]
    cut = F.when(F.col("y") == 1, int(share[1] * (1 << 20))).otherwise(int(share[0] * (1 << 20)))
    y = y.where((fold_col(id_col, 4) != 2) & (F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < cut))
    rows = written(docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(y), id_col)
                   .select("text", "y"), "toxic-sample")
    return (rows.withColumn("copy", F.xxhash64("text")).dropDuplicates(["copy", "y"])   # copies teach once
            .select("text", "y", F.when(F.col("y") == 1, 1 / max(share[1], 1e-9)).otherwise(
                1 / max(share[0], 1e-9)).alias("w")))


def learn_stems(rows: DataFrame, max_stems: int = MAX_STEMS) -> dict[str, float]:
    """Word stems, and whole words (``word$``), found in toxic documents and hardly ever in clean ones.

    The weight is the smoothed log odds of a document being toxic; a stem is
    left out if a shorter one stands for it.
    """
    def count(batches):
        toxic, clean = Counter(), Counter()

        def flush():
            both = list(toxic.keys() | clean.keys())
            return {"stem": both, "toxic": [toxic[s] for s in both], "clean": [clean[s] for s in both]}

        for b in batches:
            for text, y in zip(b["text"], b["y"], strict=True):
                own = {t for t in _TOKEN.findall(text.lower()) if len(t) > 2} if text else set()
                stems = {t + "$" for t in own}
                stems.update(t[:n] for t in own for n in STEM_CHARS if n <= len(t))
                (toxic if y else clean).update(stems)
            if len(toxic) + len(clean) > CACHE_WORDS:
                yield flush()
                toxic.clear()
                clean.clear()
        yield flush()

    counted = (map_batches(rows.select("text", "y"), count, "stem string, toxic long, clean long")
               .groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")))
    n = rows.groupBy().agg(F.sum("y"), F.sum(1 - F.col("y"))).collect()[0]
    n_toxic, n_clean = max(1, n[0] or 0), max(1, n[1] or 0)
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("c") + 0.5) / (n_clean + 1.0))
    least = max(4, n_toxic // 100)
    best = (counted.where((F.col("t") >= least) & (odds >= 4.0)).withColumn("odds", odds)
            .orderBy(F.length("stem"), "stem").limit(max_stems * 10).collect())
    stems: dict[str, float] = {}
    for r in best:
        word = r.stem.removesuffix("$")
        if not any(word[:n] in stems for n in range(1, len(word) + 1)) and len(stems) < max_stems:
            stems[r.stem] = min(2.0, float(r.odds) / 4.0)
    return stems


def learn_weights(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) / w.sum() - ridge * np.append(beta[:-1], 0) / 10
        h = (x * (w * p * (1 - p))[:, None]).T @ x / w.sum() + ridge / 10 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(h, grad), -2, 2)
    return beta


@dataclass
class Model:
    stems: dict[str, float]
    beta: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learn stems and clause weights from at most about ``FIT_TOXIC`` + ``FIT_CLEAN`` labelled
    rows outside the held-out fold (crc32 of the id modulo 4 is 2). What
    reaches the driver is stems and four numbers a row of that sample."""
    small_batches(docs.sparkSession)
    rows = _labelled(docs, labels, id_col, text_col, label_col)
    stems = learn_stems(rows)

    def run(batches):
        matcher = Matcher(stems)
        for b in batches:
            yield {"x": [list(matcher.features(t)) for t in b["text"]], "y": b["y"], "w": b["w"]}

    sample = map_batches(rows, run, "x array<double>, y int, w double").collect()
    if len({r.y for r in sample}) < 2:
        return Model(stems, np.array([1.0, 1.0, 1.0, 1.0, -3.0]))
    return Model(stems, learn_weights(np.array([r.x for r in sample]), np.array([r.y for r in sample], float),
                                      np.array([r.w for r in sample])))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_clauses`` for each row: the probability of the label
    ``toxic`` and how many clauses matched.

    Null, empty and clean texts get the probability of a text without matched
    clauses. Repeated rows and null ids: a row each. Empty table: no rows.
    Other columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.beta))

    def run(batches):
        stems, beta = shared.value
        matcher = Matcher(stems)
        for b in batches:
            x = np.array([matcher.features(t) for t in b["text"]]).reshape(-1, len(FEATURES))
            p = 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
            yield {"doc_id": b["doc_id"], "score": p.tolist(), "n_clauses": np.rint(np.expm1(x[:, 3])).astype(
                int).tolist()}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run,
                       "doc_id long, score double, n_clauses long")
