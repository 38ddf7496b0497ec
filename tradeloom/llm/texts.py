"""Words, hashes and spans of a column of texts, as arrays over the column's UTF-8 bytes.

A batch of texts is cut into slices of bounded size, so that the arrays made for a slice
stay small however many or long the texts are; a single text is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18
SLICE_ROWS = 1 << 10
# Bytes for which 64-bit values are made at once.
PIECE = 1 << 20
# Words are separated by these: space, and tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Values of bytes in word hashes, and the factor between neighbouring bytes.
BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
_C = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None


def trim() -> None:
    """Give memory that arrays no longer use back to the system.

    Workers live through many tasks, and several share an executor's memory.
    """
    pa.default_memory_pool().release_unused()
    if _C is not None:
        _C.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), FACTOR, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Texts:
    """Bytes of some texts one after another; text i is data[offsets[i]:offsets[i + 1]]."""

    first: int  # row of the first text in the batch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Words of a slice: bounds in its bytes, the text each is in, and its lower-case hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def slices(column: pa.Array) -> Iterator[Texts]:
    """The texts of a column in slices of at most SLICE_ROWS and about SLICE_BYTES; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1)
        j = min(j, i + SLICE_ROWS)
        yield Texts(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j
    trim()


def runs(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that are `inside`, never across texts: starts, ends, texts."""
    n = len(texts.data)
    bounds = np.zeros(n + 1, dtype=bool)
    bounds[texts.offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | bounds[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | bounds[1:])) + 1
    doc = np.searchsorted(texts.offsets, start, side="right") - 1
    return start, end, doc


def prefix_values(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Callable:
    """Function of lengths: an unmixed 64-bit value of that many first bytes of each run, or of some."""
    length = end - start
    firsts = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(firsts[-1]) - np.repeat(firsts[:-1], length)
    values = BYTE_VALUE[data[place + np.repeat(start, length)]]
    if len(values):
        values *= powers(int(length.max()))[place]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])

    def value(n: np.ndarray, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        at = firsts[:-1][of]
        return total[at + n[of]] - total[at] + n[of].astype(np.uint64)

    return value


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; about PIECE bytes of runs are in work at once."""
    length = end - start
    upto = np.cumsum(length)
    cuts = np.searchsorted(upto, np.arange(PIECE, upto[-1], PIECE)) if len(upto) else np.zeros(0, np.int64)
    bounds = np.unique(np.concatenate([[0], cuts, [len(start)]]))
    out = np.empty(len(start), np.uint64)
    for a, b in zip(bounds[:-1], bounds[1:]):
        out[a:b] = prefix_values(data, start[a:b], end[a:b])(length[a:b])
    return mix(out)


def words(texts: Texts) -> Words:
    start, end, doc = runs(texts, ~SPACE[texts.data])
    return Words(start, end, doc, run_hashes(LOWER[texts.data], start, end))


def sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


# Bits of a shingle's hash; the rest of 64 holds the text's number in its slice.
SHINGLE_BITS = 54


def shingles(found: Words, n: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct `size`-word shingles of each of n texts, ordered by text and hash.

    A text of fewer words has its whole sequence as one shingle; without words it has none.
    Returns texts and hashes of SHINGLE_BITS bits.
    """
    counts = np.bincount(found.doc, minlength=n)
    firsts = np.cumsum(counts) - counts
    total = len(found.hash)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    steps = powers(size)
    padded = np.concatenate([found.hash, np.zeros(size, np.uint64)])
    value = np.zeros(total, np.uint64)
    left = (firsts + counts)[found.doc] - np.arange(total)  # words from here to the end of the text
    short = left < size
    for k in range(size):
        value += padded[k : k + total] * steps[k]
    keep = ~short
    for i in np.flatnonzero(short & (counts[found.doc] == left)):  # texts of fewer words
        value[i] = (found.hash[i : i + left[i]] * steps[: left[i]]).sum(dtype=np.uint64) + np.uint64(left[i])
        keep[i] = True
    shift = np.uint64(SHINGLE_BITS)
    key = (found.doc[keep].astype(np.uint64) << shift) | (mix(value[keep]) >> (np.uint64(64) - shift))
    key.sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    return (key >> shift).astype(np.int64), key & ((np.uint64(1) << shift) - np.uint64(1))
