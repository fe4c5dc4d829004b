"""Column-level building blocks (no shuffles): text cleaning, phrase hits,
sentiment normalisation, vector helpers."""

from tidemark.functions.text import (
    clean_regex,
    join_tokens,
    phrase_hits,
    remove_stopwords_col,
    tokenize,
)
from tidemark.functions.vectors import zero_vector

__all__ = [
    "clean_regex",
    "tokenize",
    "remove_stopwords_col",
    "join_tokens",
    "phrase_hits",
    "zero_vector",
]
