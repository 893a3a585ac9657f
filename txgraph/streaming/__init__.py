"""Structured Streaming form of the weekly job: new week folders in, weekly rows out."""

from txgraph.streaming.weekly_stream import start_weekly_stream

__all__ = ["start_weekly_stream"]
