"""DataFrame operators: periods, text cleaning, spelling, lemmas, sentiment,
vectors, splits."""

from tidemark.operators.embedding import (
    encode_text,
    mean_word_vector,
    period_mean_vector,
    post_vectors,
)
from tidemark.operators.lemma import lemmatize_tokens
from tidemark.operators.periods import (
    PERIOD_KEYS,
    aggregate_periods,
    fill_nulls,
    global_row_index,
    max_scale,
    period_change,
    period_spread,
    period_volume,
    volume_change,
)
from tidemark.operators.sentiment import sentiment_score
from tidemark.operators.spelling import correct_tokens
from tidemark.operators.split import (
    positional_split,
    sample_groups,
    split_by_group,
)
from tidemark.operators.text import (
    clean_text,
    frequency_dictionary,
    vocabulary,
    with_tokens,
)

__all__ = [
    "PERIOD_KEYS", "aggregate_periods", "period_volume", "period_spread", "period_change",
    "volume_change", "max_scale", "fill_nulls", "global_row_index",
    "clean_text", "with_tokens", "vocabulary", "frequency_dictionary",
    "correct_tokens", "lemmatize_tokens", "sentiment_score",
    "post_vectors", "mean_word_vector", "period_mean_vector", "encode_text",
    "split_by_group", "sample_groups", "positional_split",
]
