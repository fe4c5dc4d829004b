"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Each task tokenises its documents and packs them in groups of about
``group_tokens`` tokens as it reads, so no token id is shuffled and memory is
bounded by a group. Documents are cut where they fill whole sequences; the
remainders are taken in descending length and each goes to the sequence of
the group with the lowest estimated cost (linear in tokens plus quadratic
attention within a document) that still has room for it; if none has, it is
cut to fill the roomiest one. A group's last tokens, fewer than a sequence,
get sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches
from tidemark.llm.tokens import Encoder, added_tokens

LENGTH = 2048
END_ID = 1
GROUP_TOKENS = 2_000_000      # tokens packed together: 8 MB of ids, about 1,000 sequences
MODEL_WIDTH = 1024            # ratio of the linear to the quadratic part of the cost
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, cost double")


def attention_cost(length, width: int = MODEL_WIDTH):
    """Cost of a piece in tokens: the layers' linear work plus attention over the piece itself
    (24 w^2 and 4 w n operations a token)."""
    return length + length * length / (6.0 * width)


def assign(lengths: list[int], length: int = LENGTH,
           width: int = MODEL_WIDTH) -> list[tuple[int, int, int, int, int]]:
    """Place pieces of the given lengths, each below ``length``.

    Returns ``(piece, start in the piece, length, sequence, offset)``; the
    sequences hold all tokens exactly, full ones of ``length`` and at the end
    powers of two.
    """
    total = sum(lengths)
    rest = total % length
    room = np.array([length] * (total // length)
                    + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], np.int64)
    size, cost = room.copy(), np.zeros(len(room))
    todo = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(todo)
    placed = []
    while todo:
        n, i, start = heapq.heappop(todo)
        n = -n
        fits = np.where(room >= n, cost, np.inf)
        s = int(fits.argmin())
        take = n
        if fits[s] == np.inf:
            s = int(room.argmax())
            take = int(room[s])
            heapq.heappush(todo, (take - n, i, start + take))
        placed.append((i, start, take, s, int(size[s] - room[s])))
        room[s] -= take
        cost[s] += attention_cost(take, width)
    return placed


def pack(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, tokenizer: str | None = None,
         group_tokens: int = GROUP_TOKENS, width: int = MODEL_WIDTH, added: str | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost``.

    A document's ids are its text's followed by ``end_id``. Added tokens of the
    file ``added`` (default: ``byte_bpe_50k.json``) that stand in a text are one
    id each, as the library has it by default. Null and empty
    texts are documents of that one id. Null ids and repeated rows are packed
    like any other row. Empty table: no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        encoder = Encoder(tokenizer, added=added_tokens(added))
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        out: dict[str, list] = {c: [] for c in names}
        held: list[tuple[int, int, int, bytes]] = []       # id, start, tokens of its document, ids
        tokens = 0

        def add(doc, start, ids, doc_tokens, seq, offset):
            n = len(ids) // 4
            for c, v in zip(names, (doc, start, n, zlib.crc32(ids), doc_tokens, seq, offset,
                                    attention_cost(n, width)), strict=True):
                out[c].append(v)

        def flush() -> None:
            nonlocal held, tokens, sequence
            top = -1
            for i, start, n, s, offset in assign([len(h[3]) // 4 for h in held], length, width):
                doc, begin, doc_tokens, ids = held[i]
                add(doc, begin + start, ids[4 * start:4 * (start + n)], doc_tokens, sequence + s, offset)
                top = max(top, s)
            sequence += top + 1
            held, tokens = [], 0

        for b in batches:
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                whole = n // length * length
                for start in range(0, whole, length):
                    add(doc, start, ids[4 * start:4 * (start + length)], n, sequence, 0)
                    sequence += 1
                if whole < n:
                    held.append((doc, whole, n, ids[4 * whole:]))
                    tokens += n - whole
                if tokens >= group_tokens:
                    flush()
            if len(out["doc_id"]) >= 5000:
                yield out
                out.update({c: [] for c in names})
        flush()
        yield out

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       run, SCHEMA)
