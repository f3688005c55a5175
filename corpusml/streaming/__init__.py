"""Streaming: score newly arriving document files with a fitted classifier."""

from corpusml.streaming.scoring import document_stream, score_stream

__all__ = ["document_stream", "score_stream"]
