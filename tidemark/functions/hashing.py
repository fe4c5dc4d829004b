"""Seeded hashes of row keys that other engines can reproduce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 52


def seeded_hash(cols: Sequence[Column | str], *salt) -> Column:
    """52 bits of the MD5 of the values and salts written as text and joined by ``|`` (null: empty)."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    text = F.concat_ws("|", *parts, *[F.lit(str(s)) for s in salt])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def seeded_uniform(cols: Sequence[Column | str], *salt) -> Column:
    """U[0, 1) of :func:`seeded_hash`."""
    return seeded_hash(cols, *salt) / F.lit(float(1 << BITS))


def token_bucket(token: Column | str, buckets: int) -> Column:
    """The bucket of a token in a hashed bag of words."""
    t = F.col(token) if isinstance(token, str) else token
    return (F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("long") % buckets).cast("int")
