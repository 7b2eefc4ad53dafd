"""Structured Streaming entry points."""

from .scoring import run_stream_predictions, scored_stream  # noqa: F401
