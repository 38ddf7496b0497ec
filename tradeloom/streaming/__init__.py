"""Structured Streaming: publish, encode, append and monitor."""
