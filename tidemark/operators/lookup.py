"""Size-checked lookups.

``bounded_count`` proves a table small before it is broadcast or inlined.
``value_sets`` turns a small ``key -> numeric value`` table into one
literal key set per distinct value; ``t.isin(set)`` compiles to a hash-set
test inside the projection, so a lexicon lookup costs O(1) per token with
no join and no shuffle of the big side. (A map literal would not do: map
lookups in Spark scan the keys linearly.)
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes allowed in a broadcast lookup table (counted: rows times their width).
DEFAULT_BROADCAST_BYTES = 128 << 20
# Keys allowed as literal sets in a plan (shipped with every task), and
# distinct values among them.
DEFAULT_INLINE_KEYS = 50_000
DEFAULT_INLINE_VALUES = 200


def bounded_count(table: DataFrame, limit: int) -> int | None:
    """Row count of ``table`` if it is at most ``limit``, else None
    (reads at most ``limit + 1`` rows)."""
    if limit <= 0:
        return None
    n = table.limit(limit + 1).count()
    return n if n <= limit else None


def _width(col: str, kind: T.DataType) -> Column:
    """Bytes of a value in memory, about."""
    c = F.col(f"`{col}`")
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(c) + 24
    elif isinstance(kind, T.ArrayType):
        size = F.size(c) * 8 + 32
    elif isinstance(kind, VectorUDT):
        size = F.size(vector_to_array(c)) * 8 + 48
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(8)).cast("long")


def bounded_bytes(table: DataFrame, limit: int) -> int | None:
    """Bytes of ``table`` if they are at most ``limit``, else None (one pass over the table)."""
    if limit <= 0:
        return None
    width = F.lit(16)
    for f in table.schema.fields:
        width = width + _width(f.name, f.dataType)
    total = table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return int(total) if total <= limit else None


def join_lookup(big: DataFrame, small: DataFrame, on, how: str = "inner",
                limit: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join a large (often exploded) table with a lookup table.

    The lookup side is broadcast only if its counted bytes are within
    ``limit``. Otherwise the join is pinned to a shuffle sort-merge join: an
    exploded side can carry a tiny static size estimate (it inherits its
    parent's), and the planner must never try to broadcast it; AQE still
    splits skewed (hot) keys.
    """
    if bounded_bytes(small, limit) is not None:
        return big.join(F.broadcast(small), on, how)
    return big.join(small.hint("shuffle_merge"), on, how)


def value_sets(table: DataFrame, key: str, value: str,
               max_keys: int = DEFAULT_INLINE_KEYS,
               max_values: int = DEFAULT_INLINE_VALUES) -> list[tuple[float, list[str]]] | None:
    """``[(value, [keys...]), ...]`` when the table is within both bounds.

    One job, which stops at ``max_keys + 1`` rows with a value other than 0: a
    larger table is never collected.
    """
    rows = (table.where(F.col(value).isNotNull() & (F.col(value) != 0)).limit(max_keys + 1)
                 .groupBy(value).agg(F.collect_set(key).alias("keys")).limit(max_values + 1).collect())
    if len(rows) > max_values or sum(len(r["keys"]) for r in rows) > max_keys:
        return None
    return sorted((float(r[value]), sorted(r["keys"])) for r in rows)
