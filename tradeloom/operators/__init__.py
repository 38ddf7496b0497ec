"""Operators that turn frames into frames: joins, repairs, transforms, codes, quality checks."""
