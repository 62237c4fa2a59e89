"""Structured Streaming twins of the batch detectors."""

from gridlens.streaming.twins import (  # noqa: F401
    file_stream, run_available_now, to_instant, to_ntz, stream_resample, stream_velocity, stream_ping,
    stream_label, stream_label_late, stream_dedup, stream_episodes, stream_copy,
)
from gridlens.streaming.velocity import TrailingCounts, stream_velocity_exact  # noqa: F401
