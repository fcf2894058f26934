"""Structured Streaming: file-source stream -> foreachBatch -> upsert logs."""

from farecast.streaming.stream import (
    Progress,
    await_progress,
    land_files,
    run_stream,
    scoring_batch,
    silver_batch,
    stream_trips,
)

__all__ = [
    "Progress", "await_progress", "land_files", "run_stream", "scoring_batch", "silver_batch",
    "stream_trips",
]
