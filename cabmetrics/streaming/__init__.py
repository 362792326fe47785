"""Streaming forms of the stateless plans."""

from .features import feature_stream, run_feature_stream, score_stream

__all__ = ["feature_stream", "run_feature_stream", "score_stream"]
