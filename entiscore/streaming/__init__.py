"""Structured Streaming operators."""

from entiscore.streaming.stream import (
    kafka_source,
    run_to_end,
    score_stream,
    stream_batch_counts,
    stream_score,
    stream_source,
    stream_tokens,
)

__all__ = ["kafka_source", "run_to_end", "score_stream", "stream_batch_counts", "stream_score",
           "stream_source", "stream_tokens"]
