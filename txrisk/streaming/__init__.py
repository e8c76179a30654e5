"""Structured Streaming: messages, scoring, replies, counts and keyed rolling features."""

from txrisk.streaming.keyed import rolling_features_state, state_reads
from txrisk.streaming.latency import answer_timed, latency_sketch, latency_summary, merge_sketches
from txrisk.streaming.messages import (
    decode,
    encode,
    ledger,
    mark,
    numbered_messages,
    read_messages,
    replay,
    replay_stream,
    to_messages,
    write_messages,
)
from txrisk.streaming.replies import match_replies
from txrisk.streaming.rolling import rolling_features_batches, rolling_features_stream
from txrisk.streaming.scoring import ProgressLog, prediction_counts, predictions, progress_rows, score_stream

__all__ = [
    "ProgressLog",
    "answer_timed",
    "decode",
    "encode",
    "latency_sketch",
    "latency_summary",
    "ledger",
    "mark",
    "match_replies",
    "merge_sketches",
    "numbered_messages",
    "prediction_counts",
    "predictions",
    "progress_rows",
    "read_messages",
    "replay",
    "replay_stream",
    "rolling_features_batches",
    "rolling_features_state",
    "rolling_features_stream",
    "score_stream",
    "state_reads",
    "to_messages",
    "write_messages",
]
