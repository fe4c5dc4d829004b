"""Cross-tokenizer alignment by inverted pair bitmaps.

A task reads texts in order and cuts both tokenizations of a text into groups at
the byte offsets where tokens of both end. Work is done per chunk (white space
and the word after it), because neither tokenizer joins letters across the start
of a chunk; a chunk's groups and links are remembered by the task.

Documents are numbered inside blocks of up to ``BLOCK_DOCS``. For each pair of
ids that is linked in a block the task holds a compressed bitmap of the block's
documents: 16-bit numbers where few bits are set, plain bits where many are. The
bitmaps of Arrow batches are OR-merged until the block is full, then written
together with a row per document. Plane 0 marks the documents with the pair, the
planes 1, 2, 4, ... the bits of how many more links than one they have, so

* popcounts of plane 0, summed over blocks, are the pair's document count,
* popcounts times the plane's weight, summed, are its link count.

Both sums are plain aggregates with map-side combining: a hot pair has a row per
block and plane and no group of rows is ever brought together. The counts go back
to the bitmaps by a join on the pair, and each block's postings return its
documents' scores; a block has a bounded number of documents, so its group is
bounded too.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import small_batches, stretches, written

BLOCK_DOCS = 2048             # documents of a block (at most 65,536: cells are 16-bit numbers)
BLOCK_LINKS = 4_000_000       # different (pair, document) cells from which a block is closed early
CACHE_CHUNKS = 150_000        # remembered chunks of a task: about 100 MB
ID_BITS = 20                  # ids of either vocabulary are below 2^20

POSTINGS = "a int, b int, plane int, dense boolean, cells binary, bits long"
DOCS = "cell int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# --- bitmaps of a block's documents

def pack_cells(docs: np.ndarray, starts: np.ndarray, n_docs: int) -> Iterator[tuple[np.ndarray, bool, pa.Array]]:
    """Compressed bitmaps of sorted documents, one per stretch that starts at ``starts``: up to two
    batches ``(which stretches, dense?, bitmaps)``."""
    sizes = np.diff(np.append(starts, len(docs)))
    width = (n_docs + 7) // 8
    dense = 2 * sizes > width
    few, many = np.flatnonzero(~dense), np.flatnonzero(dense)
    if len(few):
        data = docs[np.repeat(~dense, sizes)].astype("<u2").tobytes()
        offsets = np.append(0, np.cumsum(2 * sizes[few])).astype(np.int32).tobytes()
        yield few, False, pa.Array.from_buffers(pa.binary(), len(few), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    if len(many):
        cells = []
        for i in many:
            bits = np.zeros(8 * width, np.uint8)
            bits[docs[starts[i]:starts[i] + sizes[i]]] = 1
            cells.append(np.packbits(bits, bitorder="little").tobytes())
        yield many, True, pa.array(cells, pa.binary())


def unpack_cells(cells: pa.Array, dense: bool) -> tuple[np.ndarray, np.ndarray]:
    """Documents of all bitmaps end to end, and how many each has."""
    found = cells.to_pylist()
    if dense:
        docs = [np.flatnonzero(np.unpackbits(np.frombuffer(c, np.uint8), bitorder="little")) for c in found]
        return np.concatenate([np.zeros(0, np.int64), *docs]), np.array([len(d) for d in docs], np.int64)
    return (np.frombuffer(b"".join(found), "<u2").astype(np.int64),
            np.fromiter(map(len, found), np.int64, len(found)) // 2)


class Block:
    """The open block of a task: its cells (pair, document), each with its number of links."""

    def __init__(self) -> None:
        self.docs = self.size = 0
        self._cells: list[np.ndarray] = [np.zeros(0, np.int64)]
        self._times: list[np.ndarray] = [np.zeros(0, np.int64)]

    def add(self, pairs: np.ndarray, docs: np.ndarray, n_docs: int) -> None:
        """OR a batch in: its links' pairs, and the documents they are in, numbered from 0."""
        cells = np.sort(pairs << 16 | (docs + self.docs))
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else np.zeros(0, np.int64)
        self._cells.append(cells[first])
        self._times.append(np.diff(np.append(first, len(cells))))
        self.docs += n_docs
        self.size += len(first)

    def postings(self) -> Iterator[dict]:
        """The bitmaps of every pair and plane, as columns of ``POSTINGS``."""
        cells, more = np.concatenate(self._cells), np.concatenate(self._times) - 1
        order = np.argsort(cells, kind="stable")
        cells, more = cells[order], more[order]
        for plane in range(1 + int(more.max(initial=0)).bit_length()):
            here = cells if plane == 0 else cells[more >> (plane - 1) & 1 == 1]
            if not len(here):
                continue
            pair = here >> 16
            starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            sizes = np.diff(np.append(starts, len(here)))
            for which, dense, packed in pack_cells(here & 0xFFFF, starts, self.docs):
                ids = pair[starts[which]]
                yield {"a": ids >> ID_BITS, "b": ids & ((1 << ID_BITS) - 1), "plane": np.full(len(ids), plane),
                       "dense": np.full(len(ids), dense), "cells": packed, "bits": sizes[which]}


# --- groups of a text

def byte_tokens(path: str) -> dict[int, bytes]:
    """Bytes of every id of a byte-level vocabulary (``tokenizers`` file), added tokens left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # Printable Latin-1 letters stand for their own byte; the others' stand-ins follow 255 in byte order.
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - plain))}
    out = {i: bytes(map(byte.__getitem__, t)) for t, i in spec["model"]["vocab"].items() if set(t) <= byte.keys()}
    merged = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or merged != sorted(merged):
        raise ValueError("expects a byte-level BPE whose ids are in order of merging")
    return out


def piece_tokens(processor) -> dict[int, bytes]:
    """Bytes of every id of a sentencepiece vocabulary."""
    out = {}
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        out[i] = bytes([int(piece[1:-1], 16)]) if processor.is_byte(i) else piece.replace("\u2581", " ").encode()
    return out


class _Side:
    """One tokenizer's ids: their lengths in bytes and how they are written before the separators."""

    def __init__(self, of: dict[int, bytes], last: str):
        self.bytes, n = of, max(of) + 1
        self.size = np.zeros(n, np.int64)
        self.size[list(of)] = [len(v) for v in of.values()]
        self.inner = np.array([f"{i}," for i in range(n)], object)
        self.last = np.array([f"{i}{last}" for i in range(n)], object)


class Aligner:
    """Aligns whole texts; chunks are remembered up to ``CACHE_CHUNKS``."""

    _chunks = re.compile("[ \n]+[^ \n]*")
    # Other white space would need the tokenizers' own rules to cut at: such a text is one chunk.
    _other = re.compile("[^\\S \n]|\u180e")

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self._mark = self._b.piece_to_id("\u2581")
        self._left, self._right = _Side(byte_tokens(a_path), "|"), _Side(piece_tokens(self._b), ";")
        if max(len(self._left.size), len(self._right.size)) > 1 << ID_BITS:
            raise ValueError(f"ids must be below 2^{ID_BITS}")
        # The same merges by a faster library; without special tokens their strings are plain text.
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                    mergeable_ranks={v: i for i, v in self._left.bytes.items()})
        # A chunk starts at a space or line end after another letter: no piece of B may go on there.
        self._whole = not all(not re.search("[^\u2581]\u2581", p) and "\n" not in p for p in map(
            self._b.id_to_piece, range(self._b.get_piece_size())) if len(p) > 1)
        self._reset()

    def _reset(self) -> None:
        self._known: dict[str, int] = {}
        self._texts: list[str | None] = []                  # groups as text; None: bytes are not the chunk's
        self._sizes = np.zeros((0, 3), np.int64)            # tokens of A, of B, groups
        self._links = np.zeros(0, np.int64)
        self._starts = np.zeros(0, np.int64)

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, list[list[int]]]:
        """A's ids of all chunks end to end, B's ids of each.

        B puts a space before what it encodes: it replaces a chunk's own, or is dropped before a line end.
        """
        left, run = [], []
        for c in chunks:
            run.append(c)
            # A letter before white space ends A's tokens, so chunks that end in one can be encoded together.
            if len(run) == 500 or c[-1].isspace() or len(c) > 100:
                left += self._a.encode_ordinary("".join(run))
                run = []
        left += self._a.encode_ordinary("".join(run))
        spaced = [c[0] == " " for c in chunks]
        right = self._b.encode([c[1:] if s else c for c, s in zip(chunks, spaced, strict=True)], num_threads=1)
        # nothing is encoded as nothing, without the space
        return np.array(left, np.int64), [b[1:] if not s else [self._mark] if c == " " else b
                                          for c, s, b in zip(chunks, spaced, right, strict=True)]

    def _learn(self, chunks: list[str]) -> None:
        """Groups, links and sizes of new chunks, in arrays over all of them."""
        good = [c for c in chunks if "\u2581" not in c]      # B gives that letter back as a space
        left, right = self._encoded(good)
        letters = np.fromiter(map(len, good), np.int64, len(good))
        whole = "".join(good)
        if whole.isascii():
            size = letters
        else:
            code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            width = np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
            size = np.diff(width[np.cumsum(letters) - 1], prepend=0)
        # Both tokenizers keep all other bytes; lengths would tell if a vocabulary did not.
        b_count = np.fromiter(map(len, right), np.int64, len(right))
        b_ids = np.fromiter(chain.from_iterable(right), np.int64, int(b_count.sum()))
        same = np.add.reduceat(self._right.size[b_ids], np.cumsum(b_count) - b_count) == size if good else np.ones(0, bool)
        if not same.all():
            self._learn([c for c, s in zip(good, same.tolist(), strict=True) if s])
        elif good:
            self._keep(good, left, b_ids, size)
        for c in chunks:
            if c not in self._known:
                self._known[c] = len(self._texts)
                self._texts.append(None)
        missing = len(self._texts) - len(self._sizes)
        self._sizes = np.concatenate([self._sizes, np.zeros((missing, 3), np.int64)])
        self._starts = np.concatenate([self._starts, np.zeros(missing, np.int64)])

    def _keep(self, chunks: list[str], a: np.ndarray, b: np.ndarray, size: np.ndarray) -> None:
        a_end, b_end, ends = np.cumsum(self._left.size[a]), np.cumsum(self._right.size[b]), np.cumsum(size)
        # Groups end where tokens of both end; every chunk's end is one.
        at = np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)
        a_last = np.flatnonzero(b_end[at] == a_end)
        b_last = at[a_last]
        stop = a_end[a_last]
        # Written order: a group's tokens of A, then its tokens of B.
        a_group, b_group = np.searchsorted(stop, a_end), np.searchsorted(stop, b_end)
        b_before, a_upto = np.append(0, b_last + 1), a_last + 1
        written = np.empty(len(a) + len(b), object)
        place = np.arange(len(a)) + b_before[a_group]
        written[place] = self._left.inner[a]
        written[place[a_last]] = self._left.last[a[a_last]]
        place = np.arange(len(b)) + a_upto[b_group]
        written[place] = self._right.inner[b]
        written[place[b_last]] = self._right.last[b[b_last]]
        # Cut everything at the chunks' ends.
        groups, a_n, b_n = (np.searchsorted(e, ends, side="right") for e in (stop, a_end, b_end))
        cuts, parts = (a_n + b_n).tolist(), written.tolist()
        begin = 0
        for c, end in zip(chunks, cuts, strict=True):
            self._known[c] = len(self._texts)
            self._texts.append("".join(parts[begin:end]))
            begin = end
        sizes = np.diff(np.stack([a_n, b_n, groups], axis=1), axis=0, prepend=np.zeros((1, 3), np.int64))
        self._starts = np.concatenate([self._starts, len(self._links) + groups - sizes[:, 2]])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._links = np.concatenate([self._links, a[a_last] << ID_BITS | b[b_last]])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text ``(n_a, n_b, n_groups)`` and the digest of its groups; all links' pairs and texts' numbers."""
        cut = []
        for t in texts:
            t = " " + t if t else ""
            cut.append([t] if t and (self._whole or self._other.search(t)) else self._chunks.findall(t))
        if len(self._known) > CACHE_CHUNKS:
            self._reset()
        unknown = set().union(*cut).difference(self._known)
        if unknown:
            self._learn(list(unknown))
        digests, found, owner = [], [], []
        for i, chunks in enumerate(cut):
            at = list(map(self._known.__getitem__, chunks))
            try:
                written = "".join(map(self._texts.__getitem__, at))[:-1]      # without the last ;
            except TypeError:                                                 # a chunk whose bytes are not given back
                written = ""
            if not written:
                digests.append("")
                continue
            digests.append(hashlib.sha256(written.encode()).hexdigest())
            found.append(np.array(at, np.int64))
            owner.append(np.full(len(at), i))
        at = np.concatenate([np.zeros(0, np.int64), *found])
        owner = np.concatenate([np.zeros(0, np.int64), *owner])
        sizes = np.stack([np.bincount(owner, self._sizes[at, k], len(texts)).astype(np.int64) for k in range(3)], axis=1)
        n = self._sizes[at, 2]
        place = np.repeat(self._starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return sizes, digests, self._links[place], np.repeat(owner, n)


# --- the cluster's part

def index(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, block_docs: int = BLOCK_DOCS,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Aligned documents (``block`` and ``DOCS``) and postings (``block`` and ``POSTINGS``), written once."""
    if not 0 < block_docs <= 60_000:
        raise ValueError("a block has 1 to 60,000 documents")
    spark = docs.sparkSession
    small_batches(spark)
    schema = f"block long, {DOCS}, {POSTINGS}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        aligner = Aligner(a_path or public_tokenizers.path("byte_bpe_50k.json"),
                          b_path or public_tokenizers.path("piece_bpe_32k.model"))
        number = TaskContext.get().partitionId() << 32
        block = Block()

        def rows(columns: dict, n: int) -> pa.RecordBatch:
            columns["block"] = np.full(n, number)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, f.type) if f.name not in columns else columns[f.name] if isinstance(
                    columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for part in stretches(texts):
                here = texts[part]
                sizes, digests, pairs, owner = aligner.align(here)
                yield rows({"cell": np.arange(len(here)) + block.docs, "doc_id": ids.slice(part.start, len(here)),
                            "n_a": sizes[:, 0], "n_b": sizes[:, 1], "n_groups": sizes[:, 2], "n_links": sizes[:, 2],
                            "groups_sha256": digests}, len(here))
                block.add(pairs, owner, len(here))
                if block.docs >= block_docs or block.size >= BLOCK_LINKS:
                    for p in block.postings():
                        yield rows(p, len(p["a"]))
                    block, number = Block(), number + 1
        for p in block.postings():
            yield rows(p, len(p["a"]))

    table = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                        .mapInArrow(run, schema), "alignment")
    names = lambda ddl: [c.split()[0] for c in ddl.split(", ")]
    return (table.where(F.col("cell").isNotNull()).select("block", *names(DOCS)),
            table.where(F.col("a").isNotNull()).select(F.col("block").alias("block"), *names(POSTINGS)))


def pair_counts(postings: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links``: documents that link the pair, and links."""
    times = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    return postings.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") == 0, F.col("bits")).otherwise(0)).alias("n_docs"),
                                          F.sum(F.col("bits") * times).alias("n_links"))


def scores(aligned: DataFrame, postings: DataFrame) -> DataFrame:
    """``RESULT``: every document with the scores that its block's postings return."""
    best = F.max("n_links").over(Window.partitionBy("b"))
    counts = pair_counts(postings).withColumn("best", F.col("n_links") == best).select("a", "b", "n_links", "best")
    found = (postings.select("block", "a", "b", "plane", "dense", "cells").join(counts, ["a", "b"])
             .select("block", "plane", "dense", "cells", "n_links", "best"))

    def block_scores(docs: pa.Table, lists: pa.Table) -> pa.Table:
        cell = docs.column("cell").to_numpy()
        best, total = (np.zeros(int(cell.max()) + 1 if len(cell) else 0, np.int64) for _ in range(2))
        for dense in (False, True):
            part = lists.filter(pa.compute.equal(lists.column("dense"), dense))
            if not part.num_rows:
                continue
            where, n = unpack_cells(part.column("cells").combine_chunks(), dense)
            times = 1 << np.maximum(part.column("plane").to_numpy().astype(np.int64) - 1, 0)
            np.add.at(best, where, np.repeat(times * part.column("best").to_numpy(zero_copy_only=False), n))
            np.add.at(total, where, np.repeat(times * part.column("n_links").to_numpy(), n))
        out = docs.append_column("n_best", pa.array(best[cell])).append_column("count_sum", pa.array(total[cell]))
        return out.select([c.split()[0] for c in RESULT.split(", ")])

    return aligned.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(block_scores, RESULT)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, block_docs: int = BLOCK_DOCS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``RESULT``.

    A's tokens are those of a space and the text, B's those of the text (B adds
    the space). Null and empty texts, and texts whose tokens do not give back
    their bytes (those with U+2581), have zeros and an empty digest and link
    nothing. Null ids and repeated rows are documents of their own. Texts with
    white space other than spaces and line ends are tokenized whole, without
    the memory of chunks. Long texts: memory is a small multiple of the text.
    Ties: all pairs with a B id's highest count are its best. Empty table: no
    rows. Other columns are not read.
    """
    return scores(*index(docs, a_path, b_path, block_docs, id_col, text_col))
