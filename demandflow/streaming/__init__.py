"""Structured Streaming form of the period target (the original pipeline is batch only)."""

from demandflow.streaming.incremental import stream_weekly_target  # noqa: F401
