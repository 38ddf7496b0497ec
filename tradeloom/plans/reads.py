"""Marks a query with the fact columns it reads, so a caller can build just those."""

from __future__ import annotations

from collections.abc import Callable


def reads(*columns: str) -> Callable:
    def mark(query: Callable) -> Callable:
        query.reads = columns
        return query

    return mark
