"""Structured Streaming: score post files as they arrive."""

from tidemark.streaming.scoring import start_scoring_stream

__all__ = ["start_scoring_stream"]
