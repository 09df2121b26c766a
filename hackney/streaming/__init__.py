"""Streaming: starting and stopping queries, sinks, progress."""
