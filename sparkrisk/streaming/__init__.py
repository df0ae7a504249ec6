"""The fitted operators on streaming tables."""

from sparkrisk.streaming.score import clean_stream, score_stream, score_stream_in_batches

__all__ = ["clean_stream", "score_stream", "score_stream_in_batches"]
