"""Structured Streaming: score arriving observations, keep grouped accuracy."""

from errlens.streaming.scoring import accuracy_stream, read_stream, score_stream, start

__all__ = ["accuracy_stream", "read_stream", "score_stream", "start"]
