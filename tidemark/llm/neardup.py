"""Near-duplicate documents by order MinHash.

Shingles of five words are labelled with their occurrence number. Each of
``SKETCHES`` hash functions picks the ``PICKS`` lowest labelled shingles of a
text and keeps them in text order; two texts are candidates if one such
ordered pick is equal, which is likely for texts at a small edit distance and
unlikely for texts that share words in another order. Candidates are verified
by a banded alignment of their labelled shingles.

Exact copies are one text. Few texts under a key give all their pairs. In its
largest crowd a text is compared with the crowd's leaders, texts that are in
the most crowds. What is not linked to the first leader goes on under new keys,
made of what the texts have and that leader has not: texts that only share a
passage part ways, while copies of a variant meet again. This is repeated as
long as there are crowds, so the work grows with the number of texts and not
with the square of a crowd.

The rounds only link early what is easily linked. Afterwards all texts that
were in a crowd and are not in one component yet meet in an exact join: with
the shingles in one order, rare ones first, two alike texts share one among
the first of both (prefix filter), at places in that order and in the texts, and
with lengths, that allow the similarity. No alike pair of crowd members is missed, whatever share of their
texts a leader covers.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches, words, written
from tidemark.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 16            # equal at 0.8: half of them each; none of 16: one pair in 100,000
PICKS = 3
PAIRS_UP_TO = 12         # texts under a key that give all their pairs
LEADERS = 3              # of a crowd: texts in as many crowds as any, by three hashes
RESIDUAL_KEYS = 10       # least shingles that a text keeps of what its leader has not
ROUNDS = 6               # of leaders, before the exact join of crowd members in different components
BUCKETS = 1 << 22        # shingles are ordered by the counts of these, then by their hashes
SALT_ROWS = 1000         # rows of a shingle that one task joins with all others of it
CACHE_WORDS = 400_000
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, SKETCHES, dtype=np.uint64)
_POWERS = np.random.default_rng(7).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word) & 0xFFFFFFFF
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


def word_hashes(text: str | None, seen: _Hashes) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(seen.__getitem__, found), np.uint32, len(found))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C1
    x ^= x >> np.uint64(29)
    return x * _C2


def labelled(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Shingles in text order as distinct 64-bit numbers: hash and occurrence number.

    A text of fewer words than a shingle is one shingle.
    """
    with np.errstate(over="ignore"):
        h = hashes.astype(np.uint64)
        k = min(size, len(h))
        if not k:
            return np.zeros(0, np.uint64)
        n = len(h) - k + 1
        out = h[:n] * _POWERS[0]
        for i in range(1, k):
            out += h[i:i + n] * _POWERS[i]
        out = _mix(out)
        order = np.argsort(out, kind="stable")
        ranked = out[order]
        new = np.ones(n, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        if not new.all():
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            out[order] += (np.arange(n) - first).astype(np.uint64) * _C2
        return out


def sketch(shingles: np.ndarray, picks: int = PICKS) -> list[int]:
    """One number per hash function: its lowest shingles in text order."""
    n = len(shingles)
    if not n:
        return []
    k = min(picks, n)
    with np.errstate(over="ignore"):
        ranks = _mix(shingles[None, :] ^ _SEEDS[:, None])
        at = np.sort(np.argpartition(ranks, k - 1, axis=1)[:, :k], axis=1) if n > k else np.tile(
            np.arange(n), (len(_SEEDS), 1))
        out = _SEEDS.copy()
        for i in range(k):
            out = _mix(out ^ shingles[at[:, i]])
    return out.view(np.int64).tolist()


def alignment(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Shingles aligned in order over all shingles of both texts; 0 if below ``similarity``.

    Labelled shingles are distinct within a text, so the longest common
    subsequence is a longest increasing subsequence of the places in ``b`` of
    the shingles of ``a``. Places further apart than the shingles that may
    differ cannot be in an alignment that is good enough: the band.
    """
    n, m = len(a), len(b)
    need = int(np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9))
    if min(n, m) < need or not need:
        return 0.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(ia) < need:
        return 0.0
    near = np.abs(ia - ib) <= max(n, m) - need
    ib = ib[near][np.argsort(ia[near])]
    if (np.diff(ib) > 0).all():
        length = len(ib)
    else:
        tails: list[int] = []
        for p in ib.tolist():
            i = bisect_left(tails, p)
            tails[i:i + 1] = [p]
        length = len(tails)
    return length / (n + m - length) if length >= need else 0.0


def residual_keys(own: np.ndarray, leader: np.ndarray, leader_key: int) -> list[int]:
    """Keys of what a text has and the leader has not: the least of it under each hash function."""
    rest = np.setdiff1d(own, leader, assume_unique=True)
    with np.errstate(over="ignore"):
        if not len(rest):
            return [leader_key]
        least = _mix(rest[None, :] ^ _SEEDS[:RESIDUAL_KEYS, None]).min(axis=1)
        keys = _mix(least ^ _SEEDS[:RESIDUAL_KEYS] ^ np.array(leader_key, np.int64).view(np.uint64))
    return sorted(set(keys.view(np.int64).tolist()))


def text_key(text: Column) -> Column:
    """Texts are told apart by their MD5 (null: the empty text)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _sketches(docs: DataFrame) -> DataFrame:
    """``tid, keys`` of every distinct text with words."""
    def run(batches):
        seen, done = _Hashes(), set()
        for b in batches:
            out = {"tid": [], "keys": []}
            for tid, text in zip(b["tid"], b["text"], strict=True):
                if tid in done:
                    continue
                if len(done) < 100_000:
                    done.add(tid)
                keys = sketch(labelled(word_hashes(text, seen)))
                if keys:
                    out["tid"].append(tid)
                    out["keys"].append(keys)
            yield out

    return map_batches(docs, run, "tid binary, keys array<long>").groupBy("tid").agg(F.first("keys").alias("keys"))


def _pairs(members: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of the few texts under each key of ``(key, tid, open)``, one of them open at least."""
    together = members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("tid", "open"))).alias("t"))
    pairs = (together.select("t", F.posexplode("t").alias("i", "x"))
             .select("x", F.explode(F.slice("t", F.col("i") + 2, F.size("t"))).alias("y")))
    return pairs.where(F.col("x.open") | F.col("y.open")).select(
        F.col("x.tid").alias("a"), F.col("y.tid").alias("b"), F.lit(False).alias("lead"))


def _word_table(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """``tid, words`` (hashes of 32 bits) of the needed texts. Texts move once, and always by the same
    plan: how many are needed grows with the table."""
    def hashed(batches):
        seen = _Hashes()
        for b in batches:
            yield {"tid": b["tid"], "words": [word_hashes(t, seen).tobytes() for t in b["text"]]}

    wanted = texts.join(needed.hint("shuffle_merge"), "tid", "left_semi")
    return written(map_batches(wanted, hashed, "tid binary, words binary")
                   .groupBy("tid").agg(F.first("words").alias("words")), "near-words")


def _verified(pairs: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """``a, b, lead, similarity, keys`` of the pairs that hold; of all pairs with a leader, with the
    residual keys of ``b`` (similarity 0: not linked)."""
    def run(batches):
        last, own = None, None
        for batch in batches:
            out = {"a": [], "b": [], "lead": [], "similarity": [], "keys": []}
            for a, b, lead, wa, wb in zip(*(batch[c] for c in ("a", "b", "lead", "wa", "wb")), strict=True):
                if a != last:
                    last, own = a, labelled(np.frombuffer(wa, np.uint32))
                other = labelled(np.frombuffer(wb, np.uint32))
                s = alignment(own, other, similarity)
                if s or lead:
                    keys = residual_keys(other, own, xxhash.xxh3_64_intdigest(a) >> 1) if lead else []
                    for c, v in zip(out, (a, b, lead, s, keys), strict=True):
                        out[c].append(v)
            yield out

    # The pairs of a text stand together, so its shingles are made once for them.
    joined = (pairs.join(found.select(F.col("tid").alias("b"), F.col("words").alias("wb")), "b")
              .join(found.select(F.col("tid").alias("a"), F.col("words").alias("wa")), "a"))
    return map_batches(joined.select("a", "b", "lead", "wa", "wb"), run,
                       "a binary, b binary, lead boolean, similarity double, keys array<long>")


def _with(links: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if links is None else links.unionByName(more)


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(40)).astype(np.int64) % BUCKETS


def prefix(shingles: np.ndarray, classes: np.ndarray, similarity: float) -> tuple[np.ndarray, int]:
    """The first shingles by bucket class and hash: one of them is shared with every longer or shorter
    text that is alike, and one of the returned number of them with every longer one.

    Alike texts of n <= m shingles share at least ``similarity / (1 + similarity) * (n + m)``.
    """
    n = len(shingles)
    first = shingles[np.lexsort((shingles, classes[_buckets(shingles)]))]
    least = lambda x: int(np.ceil(x * n - 1e-9))
    return first[:n - least(similarity) + 1], n - least(2 * similarity / (1 + similarity)) + 1


def _shingle_classes(texts: DataFrame) -> np.ndarray:
    """For each bucket of shingles the logarithm of its count, in eighths of a power of two."""
    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for w in b["words"]:
                np.add.at(counts, _buckets(labelled(np.frombuffer(w, np.uint32))), 1)
        at = np.flatnonzero(counts)
        for i in range(0, len(at), 100_000):
            part = at[i:i + 100_000]
            yield {"bucket": part.tolist(), "n": counts[part].tolist()}

    found = (map_batches(texts.select("words"), run, "bucket int, n long").groupBy("bucket")
             .agg(F.sum("n").alias("n")).where(F.col("n") > 1).toArrow())
    out = np.zeros(BUCKETS, np.uint8)
    out[found.column("bucket").to_numpy()] = np.minimum(255, 8 * np.log2(found.column("n").to_numpy()))
    return out


def _exact_pairs(crowded: DataFrame, found: DataFrame, links: DataFrame | None, similarity: float) -> DataFrame:
    """``a, b, lead`` of crowd members in different components, among them all that are alike.

    A shingle whose holders are all in one component gives no pairs; one with many holders is salted.
    """
    texts = found.join(crowded.hint("shuffle_merge"), "tid", "left_semi")
    if links is not None:
        roots = components(links.select("a", "b")).withColumnRenamed("node", "tid")
        texts = texts.join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    else:
        texts = texts.withColumn("root", F.col("tid"))
    texts = written(texts.select("tid", "root", "words"), "near-crowd-words")
    shared = texts.sparkSession.sparkContext.broadcast(_shingle_classes(texts))

    def run(batches):
        classes = shared.value
        for batch in batches:
            out = {"key": [], "tid": [], "root": [], "size": [], "place": [], "at": [], "short": []}
            for tid, root, w in zip(batch["tid"], batch["root"], batch["words"], strict=True):
                own = labelled(np.frombuffer(w, np.uint32))
                first, short = prefix(own, classes, similarity)
                k, by = len(first), np.argsort(own)
                at = by[np.searchsorted(own, first, sorter=by)].tolist()
                for c, v in zip(out, (first.view(np.int64).tolist(), [tid] * k, [root] * k, [len(own)] * k,
                                      range(k), at, [i < short for i in range(k)]), strict=True):
                    out[c].extend(v)
            yield out

    rows = written(map_batches(texts, run, "key long, tid binary, root binary, size int, place int, at int, "
                                      "short boolean"), "near-prefixes")
    salts = (rows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.xxhash64("root")).alias("low"),
                                     F.max(F.xxhash64("root")).alias("high"))
             .where(F.col("low") != F.col("high")).select("key", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("s")))
    rows = written(rows.join(salts, "key"), "near-shared")
    x = rows.where("short").select("key", F.pmod(F.xxhash64("tid"), F.col("s")).cast("int").alias("salt"),
                                   *[F.col(c).alias(f"x_{c}") for c in ("tid", "root", "size", "place", "at")])
    y = rows.select("key", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("salt"),
                    *[F.col(c).alias(f"y_{c}") for c in ("tid", "root", "size", "place", "at")])
    c = F.col
    need = F.ceil(F.lit(similarity / (1 + similarity)) * (c("x_size") + c("y_size")) - 1e-9)
    pairs = x.hint("merge").join(y, [
        x["key"] == y["key"], x["salt"] == y["salt"], c("x_root") != c("y_root"),
        (c("x_size") < c("y_size")) | ((c("x_size") == c("y_size")) & (c("x_tid") < c("y_tid"))),
        F.least(c("x_size") - c("x_place"), c("y_size") - c("y_place")) >= need,
        F.abs(c("x_at") - c("y_at")) <= F.greatest("x_size", "y_size") - need])
    return written(pairs.select(F.least("x_tid", "y_tid").alias("a"), F.greatest("x_tid", "y_tid").alias("b"))
                   .distinct().withColumn("lead", F.lit(False)), "near-exact-pairs")


def near_links(docs: DataFrame, similarity: float = SIMILARITY, pairs_up_to: int = PAIRS_UP_TO,
               rounds: int = ROUNDS, text_col: str = "text") -> DataFrame:
    """Links ``a, b, similarity`` between distinct texts (by :func:`text_key`), enough to connect all alike ones."""
    small_batches(docs.sparkSession)
    texts = docs.select(text_key(F.col(f"`{text_col}`")).alias("tid"), F.col(f"`{text_col}`").alias("text"))
    members = (written(_sketches(texts), "near-sketches")
               .select("tid", F.posexplode("keys").alias("j", "h"), F.lit(True).alias("open"))
               .select("tid", F.xxhash64("j", "h").alias("key"), "open"))
    links = found = crowded = None
    for round_ in range(rounds):
        # Keys with two texts at least and one of them open, that is not linked to the leaders it has met.
        sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.max("open").alias("any"))
        members = written(members.join(sizes.where((F.col("n") > 1) & F.col("any")).drop("any"), "key"),
                          "near-members")
        if found is None:
            found = _word_table(texts, members.select("tid").distinct())
        crowd = members.where(F.col("n") > pairs_up_to)
        if not round_:
            crowded = written(crowd.select("tid").distinct(), "near-crowded")
        weight = crowd.groupBy("tid").agg(F.count("*").alias("w"))
        best = [F.max(F.struct("w", F.xxhash64("tid", F.lit(i)).alias("h"), "tid"))["tid"] for i in range(LEADERS)]
        leaders = (crowd.join(weight, "tid").groupBy("key").agg(F.array(*best).alias("top"))
                   .select("key", F.posexplode("top").alias("i", "a")))
        # A text meets the leaders of its largest crowd alone: three rows a text, however many crowds it is in.
        own = crowd.groupBy("tid").agg(F.max(F.struct("n", "key"))["key"].alias("key"))
        pairs = (own.join(leaders, "key").where(F.col("tid") != F.col("a"))
                 .select("a", F.col("tid").alias("b"), (F.col("i") == 0).alias("lead")))
        few = _pairs(members.where(F.col("n") <= pairs_up_to))
        pairs = written(few.unionByName(pairs).groupBy("a", "b").agg(F.max("lead").alias("lead")), "near-pairs")
        if pairs.isEmpty():
            break
        checked = written(_verified(pairs, found, similarity), "near-checked")
        linked = checked.where(F.col("similarity") > 0).select("a", "b", "similarity")
        links = _with(links, linked)
        members = (checked.where("lead").select(F.col("b").alias("tid"), (F.col("similarity") == 0).alias("open"),
                                                F.explode_outer("keys").alias("key"))
                   .groupBy("key", "tid").agg(F.max("open").alias("open")))
    if crowded is not None and not crowded.isEmpty():
        pairs = _exact_pairs(crowded, found, links, similarity)
        checked = written(_verified(pairs, found, similarity), "near-checked")
        links = _with(links, checked.select("a", "b", "similarity"))
    return links if links is not None else texts.sparkSession.createDataFrame(
        [], "a binary, b binary, similarity double")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, tid, class_id, class_tid, class_size`` for each document.

    A class is a set of documents connected by copies and links of at least
    ``similarity``; its id is its lowest document id, ``class_tid`` that
    document's text. Null and empty texts are copies of one another; texts
    without words are alike only if equal. Null ids come last (a class of
    nulls has a null id). Repeated rows are copies: one class, a row each.
    Empty table: no rows. Other columns are not read.
    """
    own = written(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                              text_key(F.col(f"`{text_col}`")).alias("tid")), "near-docs")
    roots = components(near_links(docs, similarity, text_col=text_col).select("a", "b"))
    placed = (own.join(roots.withColumnRenamed("node", "tid"), "tid", "left")
              .withColumn("root", F.coalesce("root", "tid")))
    # Null ids last: the lowest of (is null, id, text).
    classes = placed.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("low"),
        F.count("*").alias("class_size"))
    return placed.join(classes, "root").select(
        "doc_id", "tid", F.col("low.doc_id").alias("class_id"), F.col("low.tid").alias("class_tid"), "class_size")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with its lowest id. All columns are kept."""
    chosen = (near_classes(docs, similarity, id_col, text_col)
              .where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("tid") == F.col("class_tid")))
              .select(F.col("doc_id").alias("__id"), F.col("tid").alias("__tid")).distinct())
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(f"`{id_col}`").cast("long").alias("id"), text_key(F.col(f"`{text_col}`")).alias("tid"))
    kept = (row.join(chosen, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tid") == F.col("__tid")), "left_semi")
            .dropDuplicates(["tid", "id"]))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
