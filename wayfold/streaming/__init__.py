"""Structured Streaming: paced replay and stateful matching."""
