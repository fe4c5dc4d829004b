"""Quality rules as a short-circuit cascade.

Each rule reads some lazily computed features of a text and rejects it or
not. On a sample of the rows the cost and the rejection rate of every rule
are measured, and the rules run in descending rejections per second; a text
leaves the cascade at its first rejection. The verdict (rejected by any rule)
does not depend on the order, only the work does.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches

SAMPLE_DOCS = 400        # rows to measure the rules on, the lowest by a hash of their ids
WINDOW = 8               # words in a repeated window
_SYMBOLS = b"#*$%&|<>"
_ENDS = re.compile(rb"[.!?:;,\"')\]]$")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text.

    Windows get numbers by doubling: a window of 2n words is a pair of
    numbers of windows of n words, so equal numbers mean equal words.
    """
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    level = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    width, count = 1, len(ids)
    number = level
    while width < window:
        step = min(width, window - width)
        pair = number[:n - width - step + 1] * count + number[step:step + n - width - step + 1]
        width += step
        found, number, seen = np.unique(pair, return_inverse=True, return_counts=True)
        count = len(found)
        if count == len(pair):
            return 0
    starts = np.flatnonzero(seen[number] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


class Text:
    """Features of one text, computed when first asked for."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode("utf-8", "surrogatepass")
        self._made: dict[str, object] = {}

    def __getattr__(self, name: str):
        make = _FEATURES.get(name)
        if make is None:
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = make(self)
        return self._made[name]


def _letter_words(t: Text) -> int:
    return sum(1 for w in t.words if not w.isascii() or any(65 <= c <= 90 or 97 <= c <= 122 for c in w))


_FEATURES: dict[str, Callable[[Text], object]] = {
    "words": lambda t: t.raw.split(),
    "n_words": lambda t: len(t.words),
    # code points: all bytes but the continuation bytes of UTF-8
    "word_chars": lambda t: len(b"".join(t.words).decode("utf-8", "surrogatepass")),
    "n_symbols": lambda t: len(t.raw) - len(t.raw.translate(None, _SYMBOLS)),
    "lines": lambda t: [x for x in t.raw.split(b"\n") if x.split()],
    "n_dup_lines": lambda t: len(t.lines) - len(set(t.lines)),
    "n_repeat_words": lambda t: repeated_words(t.words),
    "n_letter_words": _letter_words,
    "n_upper": lambda t: sum(map(bytes.isupper, t.words)),
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


# Limits are fixed values of common web-text filters.
RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("duplicate_lines", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("letterless_words", lambda t: 10 * t.n_letter_words < 7 * t.n_words),
    Rule("shouting", lambda t: 2 * t.n_upper > t.n_words),
)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, n: int = SAMPLE_DOCS, id_col: str = "doc_id",
            text_col: str = "text") -> dict[str, tuple[float, float]]:
    """Each rule's rejection rate and seconds a text, over about ``n`` rows chosen by a hash of the id.

    Measured where the rows are; one row a rule comes back. A rule's cost
    includes the features it needs, each text afresh.
    """
    total = docs.count()
    share = min(1.0, n / max(total, 1))
    rows = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int((1 << 20) * share))

    def run(batches):
        for b in batches:
            out = {"rule": [], "rejected": [], "texts": [], "seconds": []}
            for rule in rules:
                items = [Text(t) for t in b["text"]]
                began = time.perf_counter()
                rejected = sum(map(rule.rejects, items))
                for c, v in zip(out, (rule.name, rejected, len(items), time.perf_counter() - began), strict=True):
                    out[c].append(v)
            yield out

    found = (map_batches(rows.select(F.col(text_col).alias("text")), run,
                         "rule string, rejected long, texts long, seconds double")
             .groupBy("rule").agg(F.sum("rejected"), F.sum("texts"), F.sum("seconds")).collect())
    return {r[0]: (r[1] / r[2], r[3] / r[2]) for r in found if r[2]}


def plan(measured: dict[str, tuple[float, float]], rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules in descending rejections per second (unmeasured ones and ties: as given)."""
    def rating(rule: Rule) -> float:
        rejected, seconds = measured.get(rule.name, (0.0, 1.0))
        return (rejected + 1e-3) / max(seconds, 1e-9)
    return sorted(rules, key=lambda r: -rating(r))


def passes(item: Text, rules: list[Rule]) -> bool:
    return not any(rule.rejects(item) for rule in rules)


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, report: tuple[str, ...] = (),
            base: tuple[str, ...] = ("few_words", "repeated_windows"), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id``, the features named in ``report`` (long), ``base_failed``, ``kept`` for each row.

    ``kept`` is the cascade's verdict; ``base_failed`` says whether a rule in
    ``base`` rejects (worked out only where it is asked for). Null and empty
    texts have no words and are rejected. Repeated rows and null ids: a row
    each. Empty table: no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    names = [r.name for r in rules]
    order = [names.index(r.name) for r in plan(measure(docs, rules, id_col=id_col, text_col=text_col), rules)]
    schema = "doc_id long, " + "".join(f"{f} long, " for f in report) + "base_failed boolean, kept boolean"

    def run(batches):
        ordered = [rules[i] for i in order]
        based = [r for r in rules if r.name in base]
        for b in batches:
            items = [Text(t) for t in b["text"]]
            out = {"doc_id": b["doc_id"], "kept": [passes(t, ordered) for t in items],
                   "base_failed": [not passes(t, based) for t in items]}
            yield out | {f: [getattr(t, f) for t in items] for f in report}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       run, schema)
