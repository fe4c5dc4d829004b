"""Spelling correction as a blocked similarity join.

For each token not in the dictionary, find the dictionary term within
``max_distance`` optimal-string-alignment edits; keep the closest, then the
most frequent (then the smallest term, for determinism). Tokens with no such
term are kept as they are.

Blocking: symmetric deletes of the first ``prefix_length`` characters. Two
words within k edits share a string reachable by at most k deletions from
each prefix, so an equi-join on (hashes of) those delete keys finds every
candidate pair without comparing all pairs. The hashes are made in numpy for
a batch of words at once: cumulative sums of a polynomial hash give that of a
word without any one or two of its characters, with no string built. The prefix is a speed setting
only: a long one makes nearly all of a word part of its keys, so that few
words share a key that are not alike. Candidates are verified on the full
words in the JVM: Levenshtein (bounded by 2k since a transposition costs 2
there) and, where it does not settle the case, the transpositions themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import SPELL_MAX_DISTANCE
from tidemark.operators.lookup import join_lookup
from tidemark.sources.io import materialize

# At most 1 + 20 + 190 keys a word.
PREFIX_LENGTH = 20


def _deletes(s: Column) -> Column:
    """All strings made by deleting one character of ``s``."""
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(s)),
                    lambda i: F.concat(s.substr(F.lit(1), i - 1), s.substr(i + 1, F.length(s)))))


def delete_keys(word: str | Column, max_distance: int = SPELL_MAX_DISTANCE,
                prefix_length: int = PREFIX_LENGTH) -> Column:
    """Distinct strings reachable by <= ``max_distance`` deletions of the prefix."""
    w = F.col(word) if isinstance(word, str) else word
    prefix = w.substr(F.lit(1), F.lit(prefix_length))
    level = F.array(prefix)
    keys = [level]
    for _ in range(max_distance):
        level = F.array_distinct(F.flatten(F.transform(level, _deletes)))
        keys.append(level)
    return F.array_distinct(F.concat(*keys))


# An odd base of the polynomial hash modulo 2**64.
_BASE = 0x9E3779B97F4A7C15


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Code points as well mixed 64-bit numbers (splitmix64)."""
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _delete_hashes(x: np.ndarray, max_distance: int) -> np.ndarray:
    """Hashes of ``delete_keys`` of words of one length, a row of mixed characters each (rows may repeat a hash)."""
    n, length = x.shape
    powers = np.array([pow(_BASE, i, 1 << 64) for i in range(length + 2)], np.uint64)
    sums = []            # up to a character, as if 0, 1 or 2 were deleted before it
    for gone in range(max_distance + 1):
        to = np.zeros((n, length + 1), np.uint64)
        np.cumsum(x * powers[2 - gone:2 - gone + length], axis=1, dtype=np.uint64, out=to[:, 1:])
        sums.append(to)
    keys = [sums[0][:, length:]]
    if length >= 1:
        i = np.arange(length)
        keys.append(sums[0][:, i] + sums[1][:, length:] - sums[1][:, i + 1])
    if max_distance == 2 and length >= 2:
        i, j = np.triu_indices(length, 1)
        keys.append(sums[0][:, i] + sums[1][:, j] - sums[1][:, i + 1] + sums[2][:, length:] - sums[2][:, j + 1])
    return np.concatenate(keys, axis=1)


def _keyed(max_distance: int, prefix_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: adds ``parity`` and ``keys`` to rows whose first column is a word.

    ``parity``: a bit per class of characters, set if the word has an odd
    number of them. ``keys``: the distinct hashes of its delete keys. Rows
    without a word are dropped; rows come in another order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            lengths: dict[int, list[int]] = {}
            for i, w in enumerate(words):
                if w is not None:
                    lengths.setdefault(len(w), []).append(i)
            for length, rows in lengths.items():
                codes = np.frombuffer("".join([words[i] for i in rows]).encode("utf-32-le", "surrogatepass"), "<u4")
                x = _mixed(codes.reshape(len(rows), length))
                parity = np.bitwise_xor.reduce(np.uint64(1) << (x >> np.uint64(58)), axis=1)
                keys = np.sort(_delete_hashes(x[:, :prefix_length], max_distance), axis=1)
                new = np.ones(keys.shape, bool)
                new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                ends = np.concatenate([[0], np.cumsum(new.sum(axis=1))]).astype(np.int32)
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(parity.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[new].view(np.int64)))],
                    names=[*batch.schema.names, "parity", "keys"])
    return run


def with_delete_hashes(words: DataFrame, max_distance: int = SPELL_MAX_DISTANCE,
                       prefix_length: int = PREFIX_LENGTH) -> DataFrame:
    """A row for each distinct delete key of the word in the first column: all columns, ``parity``, ``key`` (a hash)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields)
    keyed = words.mapInArrow(_keyed(max_distance, prefix_length), f"{fields}, parity long, keys array<long>")
    return keyed.select(*words.columns, "parity", F.explode("keys").alias("key"))


def osa(a: str, b: str) -> int:
    """Optimal string alignment distance (adjacent transposition costs 1); checks the Column forms below."""
    la, lb = len(a), len(b)
    prev2 = None
    prev = list(range(lb + 1))
    for i in range(1, la + 1):
        cur = [i] + [0] * lb
        ca = a[i - 1]
        for j in range(1, lb + 1):
            cb = b[j - 1]
            cost = 0 if ca == cb else 1
            v = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + cost)
            if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                v = min(v, prev2[j - 2] + 1)
            cur[j] = v
        prev2, prev = prev, cur
    return prev[lb]


def _one_adjacent_swap(a: Column, b: Column) -> Column:
    """``b`` is ``a`` with exactly one pair of neighbours swapped."""
    swapped = lambda i: F.concat(a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)),
                                 a.substr(i, F.lit(1)), a.substr(i + 2, F.length(a)))
    return (F.length(a) == F.length(b)) & (F.length(a) >= 2) & F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: swapped(i) == b)


def _within_one(a: Column, b: Column) -> Column:
    return (F.levenshtein(a, b, 1) >= 0) | _one_adjacent_swap(a, b)


def _swap_and_one_more(a: Column, b: Column) -> Column:
    """``b`` is ``a`` after an adjacent swap and at most one more edit or swap beside the swapped pair."""
    def parts(s: Column, i: Column) -> tuple[Column, ...]:
        return (s.substr(F.lit(1), i - 1), s.substr(i, F.lit(1)), s.substr(i + 1, F.lit(1)),
                s.substr(i + 2, F.length(s)))

    def at(i: Column, j: Column) -> Column:
        (ah, a1, a2, at_), (bh, b1, b2, bt) = parts(a, i), parts(b, j)
        return ((j >= 1) & (j + 1 <= F.length(b)) & (a1 == b2) & (a2 == b1)
                & (((ah == bh) & _within_one(at_, bt)) | ((at_ == bt) & _within_one(ah, bh))))

    return (F.length(a) >= 2) & F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: reduce(lambda x, y: x | y, [at(i, i + d) for d in (-1, 0, 1)]))


def candidate_pairs(tokens: DataFrame, dictionary: DataFrame,
                    max_distance: int = SPELL_MAX_DISTANCE,
                    prefix_length: int = PREFIX_LENGTH) -> DataFrame:
    """``token, term, cnt, dist`` for pairs within ``max_distance`` (OSA; 1 or 2).

    A pair may appear more than once (it can share several delete keys);
    the per-token choice downstream is a ``min_by``, which duplicates do not
    change, so the large key-join output is never de-duplicated.

    Exact OSA is decided in the JVM (OSA <= Lev, and they differ only through
    adjacent transpositions, each 2 for Lev). Lev <= k: OSA = Lev, but 1 for
    Lev 2 if one adjacent swap maps one word onto the other. A larger Lev is
    within k only through transpositions, which keep the multiset of
    characters: with t transpositions and e other edits (t + e <= k,
    Lev <= 2t + e) the parities of the characters' counts differ in at most
    2e classes. They are computed once per word, before the join. For the few
    pairs that pass, the place of a swap is tried out.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance is 1 or 2")
    tk = (with_delete_hashes(tokens.select("token"), max_distance, prefix_length)
          .withColumnRenamed("parity", "token_parity"))
    dk = with_delete_hashes(dictionary.select("term", "cnt"), max_distance, prefix_length)
    a, b, lev = F.col("token"), F.col("term"), F.col("lev")
    apart = F.bit_count(F.col("token_parity").bitwiseXOR(F.col("parity")))
    possible = F.lit(False)
    for extra in range(1, max_distance + 1):
        e = max_distance - extra          # edits left beside the transpositions
        possible = possible | ((lev == max_distance + extra) & (apart <= 2 * e))
    # Both sides are exploded (their static size estimates are too small):
    # pin a shuffle sort-merge join so neither is broadcast; AQE splits hot keys.
    kept = (tk.join(dk.hint("shuffle_merge"), "key")
              .where(F.abs(F.length("token") - F.length("term")) <= max_distance)
              .withColumn("lev", F.levenshtein("token", "term", 2 * max_distance))
              .where(((lev >= 0) & (lev <= max_distance)) | possible))
    swapped = _one_adjacent_swap(a, b) if max_distance == 1 else _swap_and_one_more(a, b)
    dist = (F.when((lev == 2) & _one_adjacent_swap(a, b), 1).when(lev <= max_distance, lev)
            .when(swapped, max_distance))
    return (kept.select("token", "term", "cnt", dist.cast("int").alias("dist"))
            .where(F.col("dist").isNotNull()))


def correct_tokens(tokens: DataFrame, dictionary: DataFrame,
                   max_distance: int = SPELL_MAX_DISTANCE,
                   prefix_length: int = PREFIX_LENGTH) -> DataFrame:
    """``token, corrected, distance`` for every distinct ``token``.

    ``dictionary`` is ``term, cnt`` with unique terms. ``distance`` is NULL
    when the token is kept because nothing is close enough. The distinct
    tokens, flagged as known or not, are written once (one row per word) as
    they feed the candidate join and the final result.
    """
    terms = dictionary.select(F.col("term").alias("token"), F.lit(True).alias("known"))
    flagged = materialize(join_lookup(tokens.select("token").distinct(), terms, "token", "left"),
                          "spell-vocab")
    unknown = flagged.where(F.col("known").isNull()).select("token")
    best = (candidate_pairs(unknown, dictionary, max_distance, prefix_length)
            .groupBy("token")
            .agg(F.min_by(F.struct("term", "dist"),
                          F.struct("dist", (-F.col("cnt")).alias("neg_cnt"), "term")).alias("b")))
    return (flagged.join(best, "token", "left")
                   .select("token",
                           F.when(F.col("known"), F.col("token"))
                            .otherwise(F.coalesce(F.col("b.term"), F.col("token"))).alias("corrected"),
                           F.when(F.col("known"), F.lit(0)).otherwise(F.col("b.dist"))
                            .alias("distance")))
