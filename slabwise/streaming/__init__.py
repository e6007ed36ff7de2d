"""Streaming ingest of growing arrays."""

from slabwise.streaming.frames import (
    follow_hdf5,
    ingest_fits,
    ingest_frames,
    ingest_hdf5,
    window_stats,
    window_stats_stream,
)

__all__ = ["follow_hdf5", "ingest_fits", "ingest_frames", "ingest_hdf5", "window_stats", "window_stats_stream"]
