"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs (lines, sentences in them, and pieces of very long
sentences) are hashed with their occurrence number and added to three cells
each of a small table of (count, key sum, check sum). Subtracting two tables
leaves the differing digests only; peeling cells that hold a single digest
recovers them. If that fails the sketch is built again four times as large.
The likeness of two texts is the Jaccard index of their digests, worked out
from the digests recovered.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches

CELLS = 12               # cells of a stored fingerprint, three tables of four
GROWTH = 4               # a failed sketch is built so many times larger
UNIT_CHARS = 100         # longest paragraph piece
BATCH_CHARS = 1_000_000  # text handled at once in a task
BATCH_ROWS = 64          # rows handed to Python at once: neighbours by id may all be very long
_BREAK = re.compile(r"\n|(?<=[.!?;]) ")
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def paragraphs(text: str) -> list[str]:
    out = []
    for unit in _BREAK.split(text):
        if len(unit) <= UNIT_CHARS:
            if unit:
                out.append(unit)
        else:
            out.extend(unit[i:i + UNIT_CHARS] for i in range(0, len(unit), UNIT_CHARS))
    return out


def digests(text: str) -> np.ndarray:
    """One distinct 64-bit digest per paragraph, of its occurrence number and its text.

    (A seed would not do for the number: seeded hashes of texts of a few bytes collide. Peeling
    needs distinct digests, so equal ones would count once.)
    """
    seen: dict[str, int] = {}
    out = []
    for unit in paragraphs(text):
        n = seen[unit] = seen.get(unit, -1) + 1
        out.append(xxhash.xxh3_64_intdigest(b"%d " % n + unit.encode("utf-8", "surrogatepass")))
    return np.unique(np.array(out, np.uint64))


def _mix(x: np.ndarray, c: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * c
        return x ^ (x >> np.uint64(29))


def _check(keys: np.ndarray) -> np.ndarray:
    return _mix(keys, _C[3]) >> np.uint64(32)


class Sketches:
    """Tables of ``cells`` cells for ``n`` texts, as flat arrays."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.key = np.zeros(n * cells, np.uint64)
        self.check = np.zeros(n * cells, np.uint64)

    def places(self, owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
        third = self.cells // 3
        return np.concatenate([owner * self.cells + i * third
                               + (_mix(keys, _C[i]) % np.uint64(third)).astype(np.int64) for i in range(3)])

    def add(self, owner: np.ndarray, keys: np.ndarray, sign) -> np.ndarray:
        at = self.places(owner, keys)
        sign = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        np.add.at(self.count, at, np.tile(sign, 3))
        np.bitwise_xor.at(self.key, at, np.tile(keys, 3))
        np.bitwise_xor.at(self.check, at, np.tile(_check(keys), 3))
        return at

    @staticmethod
    def of(lists: list[np.ndarray], cells: int) -> Sketches:
        out = Sketches(len(lists), cells)
        if lists:
            out.add(np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
                    np.concatenate(lists).astype(np.uint64), 1)
        return out

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.cells)
        out.count = self.count - other.count
        out.key, out.check = self.key ^ other.key, self.check ^ other.check
        return out

    def strings(self) -> list[str]:
        cell = np.zeros(self.n * self.cells, np.dtype([("n", "<i4"), ("k", "<u8"), ("c", "<u4")]))
        cell["n"], cell["k"], cell["c"] = self.count, self.key, self.check
        raw, width = cell.tobytes(), cell.itemsize * self.cells
        return [base64.b64encode(raw[i * width:(i + 1) * width]).decode() for i in range(self.n)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Recovered digests on the left and on the right of each difference, and whether all were."""
        sides = np.zeros((2, self.n), np.int64)
        cells = np.flatnonzero(self.count)
        while len(cells):
            pure = cells[(np.abs(self.count[cells]) == 1) & (_check(self.key[cells]) == self.check[cells])]
            if not len(pure):
                break
            owner, keys, sign = pure // self.cells, self.key[pure], self.count[pure]
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            first = np.ones(len(order), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
            owner, keys, sign = owner[first], keys[first], sign[first]
            np.add.at(sides, ((sign < 0).astype(np.int64), owner), 1)
            cells = np.unique(self.add(owner, keys, -sign))
        left = (self.count != 0) | (self.key != 0)
        return sides[0], sides[1], ~left.reshape(self.n, self.cells).any(axis=1)


def likeness(a: list[np.ndarray], b: list[np.ndarray], sa: Sketches | None = None,
             sb: Sketches | None = None, cells: int = CELLS) -> np.ndarray:
    """Jaccard index of each pair of digest lists, by subtracting and peeling sketches.

    ``sa`` and ``sb``: sketches of the first size, if made already. Two texts
    without paragraphs are alike (1).
    """
    na, nb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    only = np.zeros((2, len(a)), np.int64)
    todo = np.arange(len(a))
    first = sa.minus(sb) if sa is not None and sb is not None else None
    while len(todo):
        diff = first or Sketches.of([a[i] for i in todo], cells).minus(Sketches.of([b[i] for i in todo], cells))
        first = None
        left, right, done = diff.peel()
        # A false check would leave counts that no pair of lists can have.
        done &= (na[todo] - left == nb[todo] - right) & (left <= na[todo])
        only[0, todo[done]], only[1, todo[done]] = left[done], right[done]
        todo, cells = todo[~done], cells * GROWTH
    both = na - only[0]
    union = na + nb - both
    return np.where(union > 0, both / np.maximum(union, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _ranges(docs: DataFrame, ranges: int) -> tuple[np.ndarray, dict[int, int], dict[int, int]]:
    """Bounds of id ranges, each range's highest id, and the range whose last row that one follows."""
    ids = docs.select("ord")
    bounds = np.unique(np.array(ids.stat.approxQuantile(
        "ord", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else [], np.float64))
    place = _placer(bounds, {}, {})
    top = {r.part: r.top for r in ids.select(F.col("ord"), place(F.col("ord"))[0]["part"].alias("part"))
           .groupBy("part").agg(F.max("ord").alias("top")).collect()}
    filled = sorted(top)
    return bounds, top, {p: filled[i - 1] for i, p in enumerate(filled)}


def _placer(bounds: np.ndarray, top: dict[int, int], before: dict[int, int]):
    @F.pandas_udf("array<struct<part:int,copy:boolean>>")
    def place(ord_: pd.Series) -> pd.Series:
        # ranges count from the highest ids down
        part = len(bounds) - np.searchsorted(bounds, ord_.to_numpy().astype(np.float64), side="right")
        return pd.Series([[{"part": int(p), "copy": False}]
                          + ([{"part": before[p], "copy": True}] if top.get(p) == o else [])
                          for p, o in zip(part.tolist(), ord_.tolist(), strict=True)])
    return place


def fingerprint_edits(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, and how alike they are.

    One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``. A document's next one is
    that with the next lower id (after the last: the first); null ids are
    last, equal ids in the order of a hash of their texts. Null text: empty.
    Texts without paragraphs are alike to each other (1) and to nothing else.
    A table of one row follows itself. Empty table: no rows. Texts move once,
    to ranges of ids; each range also gets the first row of the next one and
    is read as a stream, so memory is bounded by a batch of texts.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_ROWS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "ord", F.coalesce(F.col("doc_id"), F.lit(-(1 << 62))))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, top, before = _ranges(rows, ranges)
    place = _placer(bounds, top, before)
    dealt = (rows.select("doc_id", "text", "ord", F.xxhash64("text").alias("tie"), F.inline(place(F.col("ord"))))
             .repartition(ranges, "part")
             .sortWithinPartitions("part", "copy", F.col("ord").desc(), "tie")
             .select("part", "copy", "doc_id", "text"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(pairs: list[tuple[int, str, str]]) -> dict[str, list]:
        known: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in known:
                known[text] = digests(text)
            return known[text]

        changed = [edited(t, n) for _, t, n in pairs]
        own, new, nxt = [of(t) for _, t, _ in pairs], [of(t) for t in changed], [of(n) for _, _, n in pairs]
        s_own, s_new = Sketches.of(own, CELLS), Sketches.of(new, CELLS)
        values = ([d for d, _, _ in pairs], [len(t) for _, t, _ in pairs],
                  [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
                  s_own.strings(), s_new.strings(), likeness(own, new, s_own, s_new).tolist(),
                  likeness(own, nxt, s_own, Sketches.of(nxt, CELLS)).tolist())
        return dict(zip(names, values, strict=True))

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        part, waiting, pairs, chars = None, None, [], 0
        for b in batches:
            for p, copy, doc, text in zip(b["part"], b["copy"], b["doc_id"], b["text"], strict=True):
                if p != part:
                    part, waiting = p, None
                if waiting is not None:
                    pairs.append((waiting[0], waiting[1], text))
                    chars += len(waiting[1])
                waiting = None if copy else (doc, text)
                if chars >= BATCH_CHARS:
                    yield finish(pairs)
                    pairs, chars = [], 0
        yield finish(pairs)

    return map_batches(dealt, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")
