"""Readers, writers and the shared scratch area."""
