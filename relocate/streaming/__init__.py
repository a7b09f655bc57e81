"""Structured Streaming: loading staged files and recording status events; increments by key."""
