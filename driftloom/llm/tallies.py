"""Counts of the words of whole texts inside tasks: rows go in, bounded tables of counts come out, Spark adds them up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

# Bytes of a text that are split at once, and entries of a table that a task holds before it hands them on.
SLICE = 1 << 20
ENTRIES = 200_000


def letters(keep: Callable[[int], bool]) -> bytes:
    """A table for bytes.translate: A-Z in lower case, bytes that don't belong to words as spaces."""
    return bytes((b + 32 if 65 <= b <= 90 else b) if keep(b) else 32 for b in range(256))


def runs(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The maximal runs of kept bytes, in lists that hold about SLICE bytes each (or one longer run)."""
    data = data.translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
