"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch lie end to end in one array of symbols. In
each round every sequence has its lowest-ranked adjacent pair merged, all
sequences at once: the pairs' ranks come from one sorted table, the least of
each sequence from one ``minimum.reduceat``, and the merged symbols are closed
up by one mask. A sequence without a pair left has its surviving symbols
counted. Only pairs beside a merge are looked up again.

A sequence's lowest pair may occur several times. Merging the leftmost alone
is always what the libraries do; merging all occurrences in one round gives
the same if the merged piece only goes into pieces of a higher rank. That is
worked out once per vocabulary, rank by rank, and ranks without that property
(in the piece vocabulary: the runs of spaces) merge one occurrence a round.
Sequences of more than ``LONG`` symbols (a run of letters without a space)
take their pairs from a heap instead, in the same order, so that a text
without any space costs n log n and not n^2.

Vocabularies: ``.model`` (sentencepiece BPE with byte fallback, identity
normaliser) and ``.json`` (tokenizers, byte-level BPE). Counts equal the
libraries', without begin, end or added special tokens, special strings inside
texts handled as the library does by default (``.model``: plain text; ``.json``:
one token each).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches, stretches

LIMIT = 4096
CACHE = 400_000          # pre-tokens remembered by a task: about 60 MB
LONG = 2_000             # symbols from which a sequence is merged by a heap
NEVER = np.int32(2**31 - 1)
SPACE = "▁"


class MergeTable:
    """Ranked pairs of symbols: ``(left, right) -> rank, merged symbol``."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], n_symbols: int):
        self.n = n_symbols
        keys = np.array([a * n_symbols + b for a, b in pairs], np.int64)
        rank = np.array([r for r, _ in pairs.values()], np.int32)
        merged = np.array([m for _, m in pairs.values()], np.int32)
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], rank[order], merged[order]
        self.lookup = dict(pairs)
        # A rank is steady if one piece alone has it and that piece only goes into pieces of a higher rank.
        top = int(rank.max(initial=-1)) + 1
        piece = np.full(top, -1, np.int64)
        self.steady = np.ones(top, bool)
        for (a, b), (r, m) in pairs.items():
            if piece[r] not in (-1, m):
                self.steady[r] = False
            piece[r] = m
        least: dict[int, int] = {}
        for (a, b), (r, _) in pairs.items():
            for part in (a, b):
                least[part] = min(least.get(part, r), r)
        for r in range(top):
            if piece[r] >= 0 and least.get(int(piece[r]), top) <= r:
                self.steady[r] = False

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (``NEVER``: no such pair) and places in the table."""
        if not len(self.keys):
            return np.full(len(left), NEVER, np.int32), np.zeros(len(left), np.int64)
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER), at


def merge_all(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every sequence to its end: surviving symbols and the number of each sequence.

    ``symbols`` holds the sequences end to end; ``lengths`` (all at least 1) cuts it.
    """
    sym = symbols.astype(np.int32)
    seq = np.repeat(np.arange(len(lengths)), lengths)
    done_sym, done_seq = [sym[:0]], [seq[:0]]
    inner = np.append(seq[1:] == seq[:-1], False) if len(seq) else np.zeros(0, bool)
    rank = np.full(len(sym), NEVER, np.int32)
    at = np.zeros(len(sym), np.int64)
    ask = np.flatnonzero(inner)
    rank[ask], at[ask] = table.find(sym[ask], sym[ask + 1])
    while len(sym):
        starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        size = np.diff(np.append(starts, len(seq)))
        least = np.minimum.reduceat(rank, starts)
        over = np.repeat(least == NEVER, size)
        if over.any():
            done_sym.append(sym[over])
            done_seq.append(seq[over])
            left = ~over
            sym, seq, rank, at = sym[left], seq[left], rank[left], at[left]
            if not len(sym):
                break
            size, least = size[least != NEVER], least[least != NEVER]
        hit = np.flatnonzero(rank == np.repeat(least, size))
        # Every other one of neighbouring hits; where the rank is not steady, the first of the sequence.
        fresh = np.append(True, np.diff(hit) != 1)
        run = np.maximum.accumulate(np.where(fresh, hit, 0))
        first = np.append(True, seq[hit[1:]] != seq[hit[:-1]])
        hit = hit[np.where(table.steady[rank[hit]], (hit - run) % 2 == 0, first)]
        sym[hit] = table.merged[at[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        place = np.cumsum(keep) - 1
        sym, seq, rank, at = sym[keep], seq[keep], rank[keep], at[keep]
        now = place[hit]
        ask = np.unique(np.concatenate([now, now[now > 0] - 1]))
        rank[ask] = NEVER
        ask = ask[ask + 1 < len(sym)]
        ask = ask[seq[ask] == seq[ask + 1]]
        rank[ask], at[ask] = table.find(sym[ask], sym[ask + 1])
    sym, seq = np.concatenate(done_sym), np.concatenate(done_seq)
    order = np.argsort(seq, kind="stable")
    return sym[order], np.bincount(seq, minlength=len(lengths))


def merge_long(symbols: list[int], table: MergeTable) -> list[int]:
    """One long sequence: the same order of merges, from a heap."""
    sym: list[int | None] = list(symbols)
    before, after = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
    found = table.lookup
    heap = [(*found[p], i) for i, p in enumerate(zip(sym, sym[1:], strict=False)) if p in found]
    heap = [(r, i, m) for r, m, i in heap]
    heapq.heapify(heap)
    while heap:
        r, i, m = heapq.heappop(heap)
        j = after[i]
        if sym[i] is None or j < 0 or found.get((sym[i], sym[j])) != (r, m):
            continue
        sym[i], sym[j] = m, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] >= 0 and (p := (sym[k], sym[after[k]])) in found:
                heapq.heappush(heap, (found[p][0], k, found[p][1]))
    return [s for s in sym if s is not None]


class _Counter:
    """Counts of whole texts; pre-tokens are merged once per batch and remembered up to ``CACHE``."""

    table: MergeTable

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        raise NotImplementedError

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the tokens end to end, and how many each token has."""
        raise NotImplementedError

    def weights(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens that each surviving symbol counts for."""
        return np.ones(len(symbols), np.int64)

    def _merge(self, tokens: list[str]) -> None:
        symbols, lengths = self.symbols(tokens)
        ends = np.cumsum(lengths)
        big = lengths > LONG
        for i in np.flatnonzero(big):
            rest = merge_long(symbols[ends[i] - lengths[i]:ends[i]].tolist(), self.table)
            self._known[tokens[i]] = int(self.weights(np.array(rest)).sum())
        small = np.flatnonzero(~big)
        if len(small):
            rest, counts = merge_all(symbols[np.repeat(~big, lengths)], lengths[small], self.table)
            starts = np.append(0, np.cumsum(counts)[:-1])
            totals = np.add.reduceat(self.weights(rest), starts)
            self._known.update(zip((tokens[i] for i in small.tolist()), totals.tolist(), strict=True))

    def counts(self, texts: list[str | None]) -> list[int]:
        cut = [self.pre_tokens(t) if t else [] for t in texts]
        if len(self._known) > CACHE:
            self._known.clear()
        unknown = set().union(*cut).difference(self._known)
        if unknown:
            self._merge(sorted(unknown))
        known = self._known
        return [sum(map(known.__getitem__, tokens)) for tokens in cut]


class PieceCounter(_Counter):
    """A sentencepiece BPE model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        super().__init__()
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, how = model.normalizer_spec, model.trainer_spec
        if (how.model_type != 2 or not how.byte_fallback or norm.name != "identity" or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or how.user_defined_symbols):
            raise ValueError("expects sentencepiece BPE with byte fallback, a space put before the text, no normalising")
        score = {p.piece: p.score for p in model.pieces if p.type == 1}
        ranks = {s: i for i, s in enumerate(sorted({score[p] for p in score if len(p) > 1}, reverse=True))}
        # Symbols: pieces, letters that occur in pieces only, and unknown letters by their number of bytes.
        ids = {p: i for i, p in enumerate(score)}
        for p in list(score):
            for c in p:
                ids.setdefault(c, len(ids))
        n = len(ids)
        pairs = {}
        for p, s in score.items():
            for i in range(1, len(p)):
                if p[:i] in ids and p[i:] in ids:
                    pairs[ids[p[:i]], ids[p[i:]]] = (ranks[s], ids[p])
        self.table = MergeTable(pairs, n + 4)
        self._weight = np.append(np.ones(n, np.int64), [1, 2, 3, 4])
        for c, i in ids.items():
            if c not in score:
                self._weight[i] = len(c.encode())
        code = np.arange(0x110000)
        self._of = (n + (code > 0x7F) + (code > 0x7FF).astype(np.int32) + (code > 0xFFFF)).astype(np.int32)
        for c, i in ids.items():
            if len(c) == 1:
                self._of[ord(c)] = i
        # Pre-tokens end where no piece goes on: before a space that follows another letter, around a line end.
        long = [p for p in score if len(p) > 1]
        if any(regex.search(f"[^{SPACE}]{SPACE}", p) for p in long):
            self._cut = None
        elif any("\n" in p for p in long):
            self._cut = regex.compile(" +[^ ]*")
        else:
            self._cut = regex.compile(" +[^ \n]*|[^ \n]+|\n")

    def pre_tokens(self, text: str) -> list[str]:
        text = " " + text.replace(SPACE, " ")
        return self._cut.findall(text) if self._cut else [text]

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(tokens).replace(" ", SPACE)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return self._of[codes], np.fromiter(map(len, tokens), np.int64, len(tokens))

    def weights(self, symbols: np.ndarray) -> np.ndarray:
        return self._weight[symbols]


class ByteCounter(_Counter):
    """A byte-level BPE of the ``tokenizers`` library."""

    def __init__(self, path: str):
        super().__init__()
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex")
                or pre.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges")
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])):
            raise ValueError("expects a byte-level BPE without a normaliser")
        # The printable stand-ins of bytes: printable Latin-1 letters stand for themselves, the others follow 255.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in plain}
        for i, b in enumerate(b for b in range(256) if b not in letters):
            letters[b] = chr(256 + i)
        ids = dict(model["vocab"])
        for c in letters.values():
            ids.setdefault(c, len(ids))
        pairs = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault((ids[a], ids[b]), (r, ids[a + b]))
        self.table = MergeTable(pairs, max(ids.values()) + 1)
        self._of = np.array([ids[letters[b]] for b in range(256)], np.int32)
        self._cut = regex.compile(public_tokenizers.PATTERN)
        special = [regex.escape(t["content"]) for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))]
        self._special = regex.compile("|".join(special)) if special else None

    def pre_tokens(self, text: str) -> list[str]:
        return self._cut.findall(text)

    def counts(self, texts: list[str | None]) -> list[int]:
        """Added tokens are cut out first, as the library does, and count one each."""
        if not self._special:
            return super().counts(texts)
        extra = [len(self._special.findall(t)) if t else 0 for t in texts]
        parts = [self._special.split(t) if n else [t] for t, n in zip(texts, extra, strict=True)]
        found = iter(super().counts([p for ps in parts for p in ps]))
        return [n + sum(next(found) for _ in ps) for n, ps in zip(extra, parts, strict=True)]

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [t.encode() for t in tokens]
        return (self._of[np.frombuffer(b"".join(coded), np.uint8)],
                np.fromiter(map(len, coded), np.int64, len(tokens)))


def counter(path: str) -> _Counter:
    return PieceCounter(path) if path.endswith(".model") else ByteCounter(path)


def count_tokens(docs: DataFrame, name: str = "piece_bpe_32k.model", path: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. Null ids and repeated rows
    give a row each; other columns are not read, whatever their names. Empty
    table: no rows. Long texts are counted whole: a text's memory is a small
    multiple of its size, and one without spaces costs n log n.
    ``path`` names a vocabulary file on the workers; by default the public file ``name``.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        import public_tokenizers

        count = counter(path or public_tokenizers.path(name))
        for b in batches:
            n = [k for part in stretches(b["text"]) for k in count.counts(b["text"][part])]
            yield {"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": n, "over_limit": [k > limit for k in n]}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
