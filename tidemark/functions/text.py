"""Text Column expressions. All run in the JVM (no UDFs); the regexes inside whole-stage
codegen, the array lambdas (filter, transform, aggregate) interpreted in the same projection.

The original program cleans text with Python's Unicode-aware ``re``:
lower-case, delete ``[^\\w\\s]``, delete ``\\d+``, split on whitespace. Java's
``\\w``/``\\s`` are ASCII-only, so the classes are spelled with Unicode
properties: Python's ``\\w`` is ``[\\p{L}\\p{N}_]``; its ``\\s`` is the ASCII
whitespace (incl. vertical tab), the Unicode spaces ``\\p{Z}`` and the
separators U+001C..U+001F and U+0085 - spelled out, as Java and RE2
disagree on the vertical tab.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import ENGLISH_STOP_WORDS, KEY_PHRASES

# Characters kept by the punctuation step: word characters and whitespace.
_WS = r"\t\n\x{0B}\f\r \p{Z}\x{1C}-\x{1F}\x{85}"
PUNCT_PATTERN = r"[^\p{L}\p{N}_" + _WS + r"]"
DIGITS_PATTERN = r"\p{Nd}+"
SPLIT_PATTERN = r"[" + _WS + r"]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_regex(text: str | Column) -> Column:
    """lower -> delete punctuation -> delete decimal digits (NULL -> '')."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    t = F.regexp_replace(t, PUNCT_PATTERN, "")
    return F.regexp_replace(t, DIGITS_PATTERN, "")


def tokenize(text: str | Column) -> Column:
    """Whitespace split with empty strings dropped (Python ``str.split()``)."""
    parts = F.split(F.coalesce(_col(text), F.lit("")), SPLIT_PATTERN)
    return F.filter(parts, lambda t: t != F.lit(""))


def remove_stopwords_col(tokens: str | Column,
                         stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drop stop words from a token array, order kept.

    The list is a bounded literal, so the test compiles to a hash-set lookup
    inside the projection - no join and no shuffle.
    """
    words = sorted(set(stop_words))
    return F.filter(_col(tokens), lambda t: ~t.isin(words))


def join_tokens(tokens: str | Column) -> Column:
    return F.concat_ws(" ", _col(tokens))


def phrase_hits(text: str | Column, phrases: Iterable[str] = KEY_PHRASES) -> Column:
    """Number of distinct phrases that occur as substrings of ``text``."""
    t = F.coalesce(_col(text), F.lit(""))
    hits = [F.when(t.contains(F.lit(p)), 1).otherwise(0) for p in phrases]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total.cast("int")


def normalise_sentiment(total: str | Column, alpha: float, decimals: int) -> Column:
    """Compound score s / sqrt(s^2 + alpha), rounded; 0 when s is NULL."""
    s = F.coalesce(_col(total).cast("double"), F.lit(0.0))
    return F.round(s / F.sqrt(s * s + F.lit(alpha)), decimals)


def token_rows(df: DataFrame, keys: Iterable[str], tokens_col: str = "tokens", out: str = "token",
               pos: str | None = None) -> DataFrame:
    """A row ``keys..., [pos,] out`` for each token.

    The outer explode with the NULLs dropped afterwards: for a plain explode
    the optimizer adds a filter on the array's size below the projection, and
    with it a second evaluation of the expressions that make the tokens.
    """
    names = [pos, out] if pos else [out]
    made = (F.posexplode_outer if pos else F.explode_outer)(tokens_col)
    return df.select(*keys, made.alias(*names)).where(F.col(out).isNotNull())
