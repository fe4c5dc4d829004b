"""Sources and sinks: post scans, lexical resources, prediction sink,
checkpointed tables, and adapters from the provided tables to posts."""

from tidemark.sources.adapters import (
    conversation_posts,
    document_posts,
    event_posts,
    read_table,
)
from tidemark.sources.io import (
    POSTS_CSV_SCHEMA,
    materialize,
    read_frequency_dictionary,
    read_lemmas,
    read_lexicon,
    read_posts,
    read_terms,
    read_word_vectors,
    write_predictions,
)

__all__ = [
    "read_table", "event_posts", "document_posts", "conversation_posts",
    "POSTS_CSV_SCHEMA", "read_posts", "write_predictions", "read_frequency_dictionary",
    "read_word_vectors", "read_terms", "read_lemmas", "read_lexicon", "materialize",
]
