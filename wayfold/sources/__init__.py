"""Readers that end in the event, road and request schemas."""
